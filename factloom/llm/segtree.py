"""Byte-level BPE (operator 13) by a segment tree over the ranks of adjacent pairs.

A leaf of the tree stands for the border behind one symbol and holds the rank of the merge across it; a node holds the least of its
leaves, so that the root yields the leftmost border of the lowest rank.  A merge ends one border and changes those beside it: three point
updates, each of as many steps as the tree has levels.  The piece is encoded once the root is empty.

The trees of short pieces stand side by side in one array, and a step merges at the root of each; a long piece has a tree of its own.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common, pretokens
from .bpe import CACHE_ENTRIES, byte_alphabet

#: No merge crosses this border.
NONE = 1 << 24
#: Bytes of pieces whose trees stand side by side, and how many of them do.
SHORT, TOGETHER = 64, 20_000


class Ranks:
    """The vocabulary and merges of a byte-level BPE file (.json): ids of bytes and of pairs, and what added tokens stand for."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, back = spec["model"]["vocab"], byte_alphabet()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = lambda s: bytes(back[c] for c in s)
        self.bytes_of = {i: t.encode() if t in self.added else raw(t) for t, i in (vocab | self.added).items()}
        self.byte_id = [vocab[c] for c, _ in sorted(back.items(), key=lambda x: x[1])]
        #: (left id, right id) to (rank, id of both).
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        if len(self.merges) >= NONE:
            raise ValueError(f"{path} has more merges than ranks can tell")
        self.span = max(self.bytes_of) + 1
        found = sorted((a * self.span + b, rank, to) for (a, b), (rank, to) in self.merges.items())
        self.pairs, self.rank_of, self.made = (np.array(c, np.int64) for c in zip(*[*found, (1 << 62, NONE, -1)]))

    def across(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair; NONE and -1 where there is no merge."""
        code = left * self.span + right
        at = np.searchsorted(self.pairs, code)
        at[self.pairs[at] != code] = len(self.pairs) - 1
        return self.rank_of[at], self.made[at]


class PairTree:
    """Least value of a row of borders, and the leftmost border that has it.

    A node holds value * width + place, so that one comparison orders by value, then by place.
    """

    def __init__(self, values: list[int]):
        self.width = 1
        while self.width < max(len(values), 1):
            self.width *= 2
        w = self.width
        row = [v * w + i for i, v in enumerate(values)]
        self.node = [0] * w + row + [NONE * w + i for i in range(len(row), w)]
        for i in range(w - 1, 0, -1):
            a, b = self.node[2 * i], self.node[2 * i + 1]
            self.node[i] = a if a < b else b

    def least(self) -> tuple[int, int]:
        return divmod(self.node[1], self.width)

    def put(self, place: int, value: int) -> None:
        node, i = self.node, self.width + place
        node[i] = value * self.width + place
        while i > 1:
            i >>= 1
            a, b = node[2 * i], node[2 * i + 1]
            least = a if a < b else b
            if node[i] == least:
                break
            node[i] = least


class PairForest:
    """The trees of many short pieces, one in each column; merge_all() encodes them all."""

    def __init__(self, ranks: Ranks, pieces: list[bytes]):
        self.ranks, m = ranks, len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, m)
        self.width = w = 1 << max(int(sizes.max()) - 1, 1).bit_length()
        data = np.frombuffer(b"".join(p.ljust(w, b"\0") for p in pieces), np.uint8).reshape(m, w).T
        #: One row more than a piece has symbols, so that the border behind the last one has none to its right.
        self.symbols = np.full((w + 1, m), -1, np.int64)
        inside = np.arange(w)[:, None] < sizes
        self.symbols[:w][inside] = np.array(ranks.byte_id)[data[inside]]
        self.after = np.repeat(np.arange(1, w + 2)[:, None], m, axis=1)
        self.before = self.after - 2
        self.node = np.full((2 * w, m), NONE * w, np.int64)
        place, piece = np.nonzero(self.symbols[1:] >= 0)
        rank, _ = ranks.across(self.symbols[place, piece], self.symbols[place + 1, piece])
        self.node[w + place, piece] = rank * w + place
        for i in range(w - 1, 0, -1):
            np.minimum(self.node[2 * i], self.node[2 * i + 1], out=self.node[i])

    def put(self, place: np.ndarray, value: np.ndarray, piece: np.ndarray) -> None:
        """Set one leaf in each of some trees, and the nodes above it."""
        node, i = self.node, place + self.width
        node[i, piece] = value * self.width + place
        while i[0] > 1:
            i = i >> 1
            node[i, piece] = np.minimum(node[2 * i, piece], node[2 * i + 1, piece])

    def merge_all(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids that are left, piece after piece, and how many each piece has."""
        symbols, after, before = self.symbols, self.after, self.before
        while len(live := np.flatnonzero(self.node[1] < NONE * self.width)):
            i = self.node[1, live] % self.width
            j = after[i, live]
            _, made = self.ranks.across(symbols[i, live], symbols[j, live])
            k = after[j, live]
            symbols[i, live], symbols[j, live], after[i, live], before[k, live] = made, -1, k, i
            behind = symbols[k, live]
            rank, _ = self.ranks.across(made, behind)
            rank[behind < 0] = NONE
            # The border behind j is gone; that behind i is a new one, and so is that before i.
            self.put(j, np.full(len(j), NONE), live)
            self.put(i, rank, live)
            some = np.flatnonzero(before[i, live] >= 0)
            if len(some):
                h, those = before[i[some], live[some]], live[some]
                self.put(h, self.ranks.across(symbols[h, those], made[some])[0], those)
        left = symbols.T >= 0
        return symbols.T[left], left.sum(axis=1)


class TreeEncoder:
    """Encodes texts that are split into pieces, each piece by its own tree; ids of a piece are kept as decimal text."""

    def __init__(self, ranks: Ranks, split: Callable[[list[str]], list[list[bytes]]] = pretokens.split):
        self.ranks, self.split = ranks, split
        self.kept: dict[bytes, bytes] = {}
        self.bytes_of_name = {b"%d" % i: b for i, b in ranks.bytes_of.items()}
        self.names = {i: b"%d" % i for i in ranks.bytes_of}

    def encode_piece(self, piece: bytes) -> list[int]:
        merges, none = self.ranks.merges, (NONE, -1)
        symbols = [self.ranks.byte_id[b] for b in piece]
        n = len(symbols)
        if n < 2:
            return symbols
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = PairTree([merges.get(pair, none)[0] for pair in zip(symbols, symbols[1:])])
        while True:
            rank, i = tree.least()
            if rank >= NONE:
                break
            j = after[i]
            symbols[i] = merges[symbols[i], symbols[j]][1]
            # The symbol at j is gone, and so is the border behind it, which is now the one behind i.
            symbols[j], k = -1, after[j]
            after[i] = k
            if k < n:
                before[k] = i
                tree.put(j, NONE)
                tree.put(i, merges.get((symbols[i], symbols[k]), none)[0])
            else:
                tree.put(i, NONE)
            if (h := before[i]) >= 0:
                tree.put(h, merges.get((symbols[h], symbols[i]), none)[0])
        return [s for s in symbols if s >= 0]

    def learn(self, pieces: list[list[bytes]]) -> dict[bytes, bytes]:
        """Encode the pieces not seen before, those of like length together."""
        if len(self.kept) > CACHE_ENTRIES:
            self.kept = {}
        fresh = set().union(*pieces).difference(self.kept)
        short = sorted((p for p in fresh if 1 < len(p) <= SHORT), key=len)
        for piece in fresh.difference(short):
            self.kept[piece] = b",".join(b"%d" % i for i in self.encode_piece(piece))
        for a in range(0, len(short), TOGETHER):
            some = short[a : a + TOGETHER]
            ids, sizes = PairForest(self.ranks, some).merge_all()
            names = list(map(self.names.__getitem__, ids.tolist()))
            ends = np.cumsum(sizes).tolist()
            self.kept.update((p, b",".join(names[b:e])) for p, b, e in zip(some, [0, *ends], ends))
        return self.kept

    def parts(self, text: str) -> list[str]:
        """The text cut at added tokens, which stand at odd places; the leftmost, then longest, counts."""
        names = sorted((a for a in self.ranks.added if a in text), key=len, reverse=True)
        out, at = [], 0
        while found := min(((i, -len(a), a) for a in names if (i := text.find(a, at)) >= 0), default=None):
            out += [text[at : found[0]], found[2]]
            at = found[0] + len(found[2])
        return [*out, text[at:]]

    def encode_joined(self, texts: list[str]) -> list[bytes]:
        """Decimal ids of each text, joined by commas."""
        cut = [self.parts(t) for t in texts]
        pieces = self.split([p for parts in cut for p in parts[::2]])
        kept, rest, out = self.learn(pieces), iter(pieces), []
        for parts in cut:
            named = [kept[p] for p in next(rest)]
            for added in parts[1::2]:
                named += [self.names[self.ranks.added[added]], *map(kept.__getitem__, next(rest))]
            out.append(b",".join(named))
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.encode_joined([text])[0].split(b",") if i]

    def decode_joined(self, joined: bytes) -> str:
        """Text of ids joined by commas, added tokens included; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of_name.__getitem__, joined.split(b","))).decode("utf-8", "replace") if joined else ""

    def forget(self) -> None:
        """Drop what was kept, so that an idle worker holds little."""
        self.kept = {}


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> TreeEncoder:
    return TreeEncoder(Ranks(path))


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """Token ids of each text by the byte-level BPE file `vocabulary` (.json), and the text that they decode to.

    Returns key, n_tokens, ids (array of int) and decoded (string); with digest, instead of these two, ids_sha256 (of the
    decimal ids joined by commas) and decoded_sha256 (of the decoded text as UTF-8).  The file's added special strings are
    one token each where they stand in a text.  A null or empty text has no ids; a null key stays; repeated rows each give a
    row; further columns, whatever their names, are left out; an empty table gives no row; a text of any length is encoded
    whole.  `vocabulary` must be readable on every executor.
    """
    common.ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    names, kinds = (("ids_sha256", "decoded_sha256"), ("string", "string")) if digest else (("ids", "decoded"), ("array<int>", "string"))

    def run(batches):
        encoder = _encoder(vocabulary)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            keys = batch.column(0)
            for a, b, texts in common.text_slices(batch):
                joined = encoder.encode_joined(texts)
                decoded = map(encoder.decode_joined, joined)
                counts = pa.array([j.count(b",") + 1 if j else 0 for j in joined], pa.int64())
                if digest:
                    out = [pa.array([sha(j) for j in joined]), pa.array([sha(d.encode()) for d in decoded])]
                else:
                    out = [pa.array([[int(i) for i in j.split(b",") if i] for j in joined], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), counts, *out], names=[key, "n_tokens", *names])
        encoder.forget()

    return rows.mapInArrow(run, f"`{key}` {kind}, n_tokens long, {names[0]} {kinds[0]}, {names[1]} {kinds[1]}")
