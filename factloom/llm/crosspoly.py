"""Embedding near-duplicates (operator 2): cross-polytope hashing after fast Hadamard rotations.

Each table of the index rotates a unit vector by three rounds of random signs and a Hadamard transform, twice, and takes
from each rotation the axis (of 2d signed axes) that it is closest to.  A vector enters the `probes` buckets that lose
least on these two axes.  Vectors that share a bucket are compared exactly, in double precision and in blocks.  A pair
that meets in many buckets counts in the first alone, which both signatures tell, so pairs are counted without being
written out: a block emits the number of links of each vector and a spanning forest of the links.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .graph import components, forest

#: Defaults: tables of the index, buckets that a vector enters in each, vectors in a block, about.
TABLES, PROBES, BLOCK = 8, 4, 512
ROUNDS, AXES = 3, 2


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def signatures(vectors: np.ndarray, tables: int = TABLES, probes: int = PROBES, axes: int = AXES, seed: int = 7) -> np.ndarray:
    """(vectors, tables, probes) bucket codes of unit vectors, those that lose least height on their axes first."""
    n, d = vectors.shape
    size = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :d] = vectors
    out = np.empty((n, tables, probes), np.int64)
    rng = np.random.default_rng([seed, size])
    reach = min(probes, 2 * size)
    for t in range(tables):
        code, loss = np.zeros((n, 1), np.int64), np.zeros((n, 1))
        for _ in range(axes):
            x = padded
            for _ in range(ROUNDS):
                x = hadamard(x * rng.choice((-1.0, 1.0), size))
            signed = np.concatenate([x, -x], axis=1)
            near = np.argpartition(-signed, reach - 1, axis=1)[:, :reach]
            height = np.take_along_axis(signed, near, axis=1)
            more = height.max(axis=1, keepdims=True) - height
            # The best few sums need only the best few of either side.
            both = (loss[:, :, None] + more[:, None, :]).reshape(n, -1)
            named = (code[:, :, None] * (2 * size) + near[:, None, :]).reshape(n, -1)
            best = np.lexsort((named, both), axis=1)[:, :probes]
            code, loss = np.take_along_axis(named, best, axis=1), np.take_along_axis(both, best, axis=1)
        out[:, t] = code
    return out


def content(vector: list | None) -> np.ndarray | None:
    """The vector in double precision; None if it can link with nothing."""
    if not vector or any(x is None for x in vector):
        return None
    x = np.array(vector, np.float64) + 0.0
    return x if np.isfinite(x).all() and x.any() else None


def normal(x: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def block_links(table: int, code: int, one: dict, two: dict | None, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, number of links, root) of the links that belong to this bucket."""
    other = one if two is None else two
    n, m = len(one["id"]), len(other["id"])
    i, j = np.nonzero(one["x"] @ other["x"].T >= threshold)
    if two is None:
        i, j = i[i < j], j[i < j]
    kept = []
    for a in range(0, len(i), 100_000):
        s, r = one["sig"][i[a : a + 100_000]], other["sig"][j[a : a + 100_000]]
        ok = np.ones(len(s), bool)
        for t in range(table):
            ok &= ~(s[:, t, :, None] == r[:, t, None, :]).any(axis=(1, 2))
        same = s[:, table, :, None] == r[:, table, None, :]
        lowest = np.where(same, s[:, table, :, None], np.iinfo(np.int64).max).min(axis=(1, 2))
        kept.append(ok & (lowest == code))
    keep = np.concatenate(kept) if kept else np.zeros(0, bool)
    i, j = i[keep], j[keep]
    if two is None:
        ids, j_at = one["id"], j
        weights = one["w"]
    else:
        ids, j_at = np.concatenate([one["id"], other["id"]]), j + n
        weights = np.concatenate([one["w"], other["w"]])
    links = np.zeros(len(ids), np.int64)
    np.add.at(links, i, weights[j_at])
    np.add.at(links, j_at, weights[i])
    root = forest(i, j_at, len(ids))
    used = np.flatnonzero(links)
    return ids[used], links[used], ids[root[used]]


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, key: str = "vec_id", column: str = "embedding", tables: int = TABLES, probes: int = PROBES, axes: int = AXES, block: int = BLOCK) -> DataFrame:
    """(key, n_links, component_id, kept) for each row of vectors.

    n_links counts the other rows whose cosine with this one is at least `threshold`, equal vectors included;
    component_id is the smallest key that links lead to; kept = key is component_id.  A vector that is null, empty, zero or
    holds a null or non-finite component links with nothing, as does a row with a null key (its component_id and kept are
    null).  Vectors of different lengths do not link.  Further columns are left out; an empty table gives no row.  No
    link below the threshold is ever counted; the share of links found is that of pairs that share a bucket.  A bucket
    holds about probes / (2d)^axes of the vectors that are no copies; for many millions of them raise `axes`, and `probes` with
    it to keep the share.
    """
    common.ship(vectors.sparkSession)
    # Vectors of float travel as such, which loses nothing; all arithmetic is in double precision.
    stored_as = np.dtype(np.float32 if vectors.schema[column].dataType.elementType.simpleString() == "float" else np.float64)
    rows = vectors.select(vectors[key].cast("long").alias("key"), vectors[column].alias("vector"))

    def read(batches):
        for batch in batches:
            found = [content(v) for v in batch.column(1).to_pylist()]
            found = [x if k is not None else None for k, x in zip(batch.column(0).to_pylist(), found)]
            digests = [None if x is None else hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in found]
            units = [None if x is None else x.astype(stored_as).tobytes() for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(units, pa.binary())], names=["key", "same", "x"])

    named = common.stored(rows.mapInArrow(read, "key long, same binary, x binary"))
    groups = common.stored(named.where("same is not null").groupBy("same").agg(F.min("key").alias("id"), F.count("*").alias("w"), F.first("x").alias("x")))

    def place(batches):
        for batch in batches:
            blobs = batch.column(2).to_pylist()
            sizes = np.array([len(b) for b in blobs])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                sig = signatures(normal(np.frombuffer(b"".join(blobs[k] for k in at), stored_as).reshape(len(at), -1)), tables, probes, axes)
                flat = np.repeat(at, tables * probes)
                take = batch.take(pa.array(flat))
                sig_bytes = sig.astype(np.int32) if sig.max(initial=0) < 2**31 else sig
                # A bucket of table t asks for the codes of the tables up to t alone.
                sigs = pa.array([s[: t + 1].tobytes() for s in sig_bytes for t in range(tables) for _ in range(probes)], pa.binary())
                t = np.tile(np.repeat(np.arange(tables, dtype=np.int32), probes), len(at))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), size, np.int32)), pa.array(t), pa.array(sig.reshape(-1)), take.column(0), take.column(1), take.column(2), sigs], names=["size", "t", "code", "id", "w", "x", "sig"])

    entries = groups.select("id", "w", "x").mapInArrow(place, "size int, t int, code long, id long, w long, x binary, sig binary")
    bucket = ["size", "t", "code"]
    hot = entries.groupBy(*bucket).count().where(F.col("count") > block).select(*bucket, F.ceil(F.col("count") / block).alias("n"))
    part = F.coalesce(F.pmod(F.xxhash64("id"), F.col("n")), F.lit(0))
    blocks = entries.join(hot, bucket, "left").withColumn("part", part).groupBy(*bucket, "part", "n").agg(F.collect_list(F.struct("id", "w", "x", "sig")).alias("one"))
    blocks = common.stored(blocks.where("n is not null or size(one) > 1"))
    within = blocks.select("t", "code", "one", F.lit(None).cast(blocks.schema["one"].dataType).alias("two"))
    # Each block of a hot bucket meets the later ones by their own place, so that no task gets all pairs of one bucket.
    left = blocks.where("part + 1 < n").select(*bucket, "one", F.explode(F.sequence(F.col("part") + 1, F.col("n") - 1)).alias("part"))
    across = left.join(blocks.where("n is not null").select(*bucket, "part", F.col("one").alias("two")), [*bucket, "part"])
    pairs = within.unionByName(across.select("t", "code", "one", "two"))

    def unpack(items, t: int) -> dict:
        values = items.values
        x = values.field("x").to_pylist()
        return {
            "id": values.field("id").to_numpy(), "w": values.field("w").to_numpy(), "x": normal(np.frombuffer(b"".join(x), stored_as).reshape(len(x), -1)),
            "sig": np.stack([np.frombuffer(b, np.int32 if len(b) == 4 * (t + 1) * probes else np.int64) for b in values.field("sig").to_pylist()]).astype(np.int64).reshape(len(x), t + 1, probes),
        }

    def compare(batches):
        for batch in batches:
            out = [block_links(t, code, unpack(one, t), unpack(two, t) if two.is_valid else None, threshold) for t, code, one, two in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["id", "links", "root"])

    found = common.stored(pairs.mapInArrow(compare, "id long, links long, root long"))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("id").alias("src"), F.col("root").alias("dst")))
    by_group = groups.select("same", "id", "w").join(counts, "id", "left").join(joined.withColumnRenamed("node", "id"), "id", "left")
    by_group = by_group.select("same", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = named.select("key", "same").join(by_group, "same", "left")
    component = F.coalesce("component_id", "key")
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("key") == component).alias("kept"))
