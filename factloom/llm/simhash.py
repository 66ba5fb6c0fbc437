"""SimHash near-duplicates (operator 10) by tiled exact comparison of all fingerprints.

Equal fingerprints are one.  Each tile holds fingerprints whose four 16-bit quarters have the same population counts.  Two
fingerprints that differ in r bits differ by r at most in the sum over quarters of these counts' differences, so a tile
meets only the tiles in that radius; all other tile pairs are skipped and no link is lost.  Within a tile pair every pair
is compared by exclusive-or and bit count, and a spanning forest of its links is emitted in place of the links.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .graph import components, forest

#: Fingerprints in a tile, about.
TILE = 2048
QUARTERS = 4


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """64 bits: bit k is set if it is set in over half of the hashes of the text's shingles, repeats included."""
    w = text.encode().lower().split()
    if not w:
        return 0
    digest = xxhash.xxh64_intdigest
    grams = zip(*(w[k:] for k in range(words))) if len(w) >= words else [w]
    hashes = np.array([digest(b" ".join(g), seed) for g in grams], "<u8")
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = hashes[a : a + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(key, fp): the fingerprint as a signed long; a null text is empty and has fingerprint 0."""
    common.ship(docs.sparkSession)
    kind = docs.schema[key].dataType
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))

    def run(batches):
        for batch in batches:
            for a, b, texts in common.text_slices(batch):
                fps = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(fps)], names=["key", "fp"])

    return rows.mapInArrow(run, f"key {kind.simpleString()}, fp long")


def offsets(radius: int) -> list[tuple[int, ...]]:
    """Differences of quarter counts within the radius, of each pair of opposites one, and none."""
    every = [d for d in itertools.product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, d)) <= radius]
    return [d for d in every if d >= (0,) * QUARTERS]


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, fingerprint) rows that span all links between a and b, or within a."""
    # Unsigned: numpy counts the bits of a signed number's absolute value.
    a, b = a.view(np.uint64), None if b is None else b.view(np.uint64)
    other = a if b is None else b
    found = []
    for k in range(0, len(a), 512):
        near = np.bitwise_count(a[k : k + 512, None] ^ other[None]) <= radius
        i, j = np.nonzero(near)
        i += k
        found.append((i[i < j], j[i < j]) if b is None else (i, j + len(a)))
    i, j = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))
    nodes = a if b is None else np.concatenate([a, b])
    root = forest(i, j, len(nodes))
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    nodes = nodes.view(np.int64)
    return nodes[moved], nodes[root[moved]]


def links(fps: DataFrame, radius: int = 2, tile: int = TILE) -> DataFrame:
    """Edges (src, dst) that connect exactly the distinct fingerprints of column fp joined by steps of radius bits or fewer.

    Fingerprints are distinct and not null; further columns do not matter; an empty table gives no edge.
    """
    quarters = [F.bit_count(F.shiftrightunsigned("fp", 16 * q).bitwiseAND(F.lit(0xFFFF))) for q in range(QUARTERS)]
    pack = lambda parts: sum((p.cast("long") * F.lit(32**q) for q, p in enumerate(parts)), F.lit(0))
    distinct = fps.select("fp", pack(quarters).alias("k"))
    # At most 17 to the power 4 keys: this table has a fixed bound.
    sizes = common.checkpointed(distinct.groupBy("k").agg(F.ceil(F.count("*") / F.lit(tile)).alias("n")))
    placed = distinct.join(F.broadcast(sizes), "k").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("n")))
    tiles = common.stored(placed.groupBy("k", "part").agg(F.collect_list("fp").alias("fps")))
    steps = F.array(*[F.lit(sum(x * 32**q for q, x in enumerate(d))) for d in offsets(radius)])
    left = tiles.select(F.col("k").alias("ka"), F.col("part").alias("pa"), F.col("fps").alias("a"), F.explode(steps).alias("step"))
    # Each tile meets each tile of a count in reach by that tile's own place, so that no task gets all pairs of one count.
    left = left.withColumn("k", F.col("ka") + F.col("step")).join(F.broadcast(sizes), "k").select("ka", "pa", "a", "step", "k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("pb"))
    right = tiles.select("k", F.col("part").alias("pb"), F.col("fps").alias("b"))
    pairs = left.where("step <> 0 or pa <= pb").join(right, ["k", "pb"]).select("a", F.when(~((F.col("step") == 0) & (F.col("pa") == F.col("pb"))), F.col("b")).alias("b"))

    def run(batches):
        for batch in batches:
            src, dst = [], []
            for a, b in zip(batch.column(0), batch.column(1)):
                x, y = tile_links(a.values.to_numpy(), b.values.to_numpy() if b.is_valid else None, radius)
                src.append(x)
                dst.append(y)
            if src:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(src)), pa.array(np.concatenate(dst))], names=["src", "dst"])

    return pairs.mapInArrow(run, "src long, dst long")


def near_duplicates(docs: DataFrame, radius: int = 2, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(key, fingerprint as 16 hex digits, component_id) for each row of docs.

    component_id is the smallest key among the texts reachable by links of `radius` or fewer differing bits, the row's own
    included.  A text without words (null, empty, blank) has fingerprint zero and links like any other.  Null keys are never a
    component_id while another key is there.  Repeated rows each give a row; further columns are left out; an empty table
    gives no row.
    """
    fps = common.stored(fingerprints(docs, key, text, words))
    groups = common.stored(fps.groupBy("fp").agg(F.min("key").alias("first")))
    joined = components(links(groups, radius))
    roots = groups.join(joined.withColumnsRenamed({"node": "fp", "component": "root"}), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = roots.select("fp", "root").join(lowest, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select(F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, radius: int = 2, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """docs with one row of each group of near duplicates: that of the group's smallest key, of repeated rows one.

    Rows with a null key stay: no key tells them apart, so none is taken for another.  Texts without words are copies of one
    another, null ones included.  Columns may have any names; an empty table stays empty.
    """
    found = near_duplicates(docs, radius, key, text, words)
    n, place, id_ = (common.unused(docs, c) for c in ("n", "place", "id"))
    chosen = common.stored(found.where(F.col(key) == F.col("component_id")).groupBy(F.col(key).alias(id_)).agg(F.count("*").alias(n)))
    # One shuffle of docs whatever their number: the list of kept keys grows with them and is never broadcast.
    kept = docs.join(chosen.hint("merge"), F.col(key) == F.col(id_))
    # Only where a key stands in more than one row do rows need a sort; without one the join is all.
    if not chosen.where(F.col(n) > 1).isEmpty():
        order = Window.partitionBy(id_).orderBy(F.xxhash64(text), text)
        kept = kept.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)
    return kept.select(docs.columns).unionByName(docs.where(F.col(key).isNull()))
