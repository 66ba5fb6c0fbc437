"""Token counts (operator 3) and byte-level BPE encoding (operator 8) over a table of texts."""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from . import bpe, common, pretokens


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> bpe.TokenCounter:
    merges, added = bpe.Merges.from_json(path)
    return bpe.TokenCounter(merges, added, pretokens.split)


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> bpe.Encoder:
    return bpe.Encoder(bpe.Merges.from_tiktoken(path), pretokens.split)




def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes and tokens of each text by the byte-level BPE file `vocabulary` (.json), with over_limit = tokens > limit.

    The file's added special strings count as one token each where they stand in a text; nothing is added or cut.  A
    null or empty text has no bytes and no tokens.  Repeated rows each give a row; further columns are left out; an
    empty table gives no row.  `vocabulary` must be readable on every executor.
    """
    common.ship(docs.sparkSession)
    kind = docs.schema[key].dataType
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))

    def run(batches):
        counter = _counter(vocabulary)
        for batch in batches:
            keys = batch.column(0)
            for a, b, texts in common.text_slices(batch):
                n = counter.counts(texts)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(a, b - a), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    names=[key, "n_bytes", "n_tokens", "over_limit"],
                )
        counter.forget()

    return rows.mapInArrow(run, f"`{key}` {kind.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")


def encode(docs: DataFrame, ranks: str, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """Token ids of each text by the rank file `ranks` (.tiktoken), and the bytes that they decode to.

    Returns key, n_tokens, ids (array of int) and decoded (binary); with digest, instead of these two, ids_sha256 (of the
    decimal ids joined by one space) and decoded_sha256.  A null or empty text has no ids.  Repeated rows each give a row;
    further columns are left out; an empty table gives no row.
    """
    common.ship(docs.sparkSession)
    kind = docs.schema[key].dataType
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))

    def run(batches):
        encoder = _encoder(ranks)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            keys = batch.column(0)
            for a, b, texts in common.text_slices(batch):
                joined = encoder.encode_joined(texts)
                counts = pa.array([j.count(b" ") + 1 if j else 0 for j in joined], pa.int64())
                if digest:
                    out = [pa.array([sha(j) for j in joined]), pa.array([sha(encoder.decode_joined(j)) for j in joined])]
                else:
                    out = [pa.array([[int(i) for i in j.split()] for j in joined], pa.list_(pa.int32())), pa.array([encoder.decode_joined(j) for j in joined], pa.binary())]
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), counts, *out], names=[key, "n_tokens", *names])
        encoder.forget()

    names, kinds = (("ids_sha256", "decoded_sha256"), ("string", "string")) if digest else (("ids", "decoded"), ("array<int>", "binary"))
    return rows.mapInArrow(run, f"`{key}` {kind.simpleString()}, n_tokens long, {names[0]} {kinds[0]}, {names[1]} {kinds[1]}")
