"""How filters of documents act on each other (operator 12): every order of the filters, by adjacent transpositions.

Documents are reduced to a mask, one bit for each filter that they fail, and counted by part, mask and labels.  All orders of the filters
are then visited so that each comes from the one before by a swap of two neighbours.  What a step removes depends on its filter and on the
set of filters before it alone, so a swap changes two steps, and these alone are added up anew from the mask cells.  A filter's
Shapley sum grows along the walk by what it removes at the moment, times the number of orders that this held for.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Kinds of cells: all documents, good ones, toxic ones.
ALL, GOOD, TOXIC = range(3)


def swaps(n: int) -> Iterator[int]:
    """Places k at which k and k + 1 are swapped, one after the other, so that every order of n things is met once."""
    if n < 2:
        return
    inner, down = swaps(n - 1), True
    while True:
        # The last thing moves through an order of the others from one end to the other.
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if (k := next(inner, None)) is None:
            return
        # While it stands at the front the others are one place further on.
        yield k + 1 if down else k
        down = not down


@functools.cache
def members(n: int) -> np.ndarray:
    """Whether a mask has a bit, by bit and mask."""
    return (np.arange(1 << n) >> np.arange(n)[:, None] & 1).astype(bool)


class Walk:
    """The steps of the current order, over cells[kind][mask]; swap() goes on to the next one."""

    def __init__(self, cells: np.ndarray, n: int):
        self.cells, self.n, self.has = cells, n, members(n)
        self.order, self.visited = list(range(n)), 1
        self.failing = [int(cells[ALL][self.has[f]].sum()) for f in range(n)]
        self.alone = [int(cells[ALL][1 << f]) for f in range(n)]
        self.steps = [self.step(k, sum(1 << f for f in self.order[:k])) for k in range(n)]
        self.shapley, self.since = [0] * n, [0] * n

    def step(self, place: int, before: int) -> tuple[int, int, int]:
        """Documents, good and toxic ones that the filter at a place removes when the filters of the set `before` come first."""
        hit = self.has[self.order[place]] & ((np.arange(1 << self.n) & before) == 0)
        return tuple(int(x) for x in self.cells[:, hit].sum(axis=1))

    def settle(self, place: int) -> None:
        """Add what the filter at a place has removed, in all orders since this last changed."""
        f = self.order[place]
        self.shapley[f] += self.steps[place][ALL] * (self.visited - self.since[f])
        self.since[f] = self.visited

    def swap(self, k: int) -> None:
        self.settle(k)
        self.settle(k + 1)
        self.order[k], self.order[k + 1] = self.order[k + 1], self.order[k]
        before = sum(1 << f for f in self.order[:k])
        self.steps[k], self.steps[k + 1] = self.step(k, before), self.step(k + 1, before | 1 << self.order[k])
        self.visited += 1

    def rows(self, names: list[str]) -> Iterator[tuple]:
        """filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost and filter of the current order's steps."""
        left = int(self.cells[ALL].sum())
        order = "".join(names[f] for f in self.order)
        for k, f in enumerate(self.order):
            removed, good, toxic = self.steps[k]
            left -= removed
            yield order, k + 1, left, removed, self.failing[f] - removed, self.alone[f], good, toxic, f

    def all_rows(self, names: list[str]) -> list[tuple]:
        """Rows of every order, each with its filter's Shapley sum in place of the filter."""
        out = list(self.rows(names))
        for k in swaps(self.n):
            self.swap(k)
            out += self.rows(names)
        for k in range(self.n):
            self.settle(k)
        return [(*r[:-1], self.shapley[r[-1]]) for r in out]


def text_filters(text: str = "text") -> dict[str, Column]:
    """Failure conditions of a text, by letter: few words, few distinct words, many capitals, marks of markup.

    Words are runs of other characters than blank and the controls 9 to 13.  A null text is empty and has no word.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(t, r"[\x20\x09-\x0D]+"), "")
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": F.regexp_count(t, F.lit("[A-Z]")) * 100 > F.length(t) * 3,
        "D": t.rlike("[#$%&*|]"),
    }


def fail_masks(docs: DataFrame, labels: DataFrame, filters: dict[str, Column], copies: str, part: str = "lang", key: str = "doc_id", text: str = "text") -> DataFrame:
    """(part, mask, all, good, toxic): numbers of documents by part and mask, as bits in the order of filters, `copies` last.

    A document fails `copies` if a smaller key has the same text, in whatever part.  Texts meet by SHA-256.  Rows are counted
    by text, part and labels before texts meet, so that copies, however many, are a few rows.  A null key is never smaller and
    never larger than another; repeated rows all count, and none fails because of its own key.  A document is good or toxic if any
    of its labels says so; null keys have no label.
    """
    name = {n: common.unused(docs, f"_{n}") for n in ("part", "mask", "text", "key")}
    bits = functools.reduce(Column.__add__, [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(filters.values())], F.lit(0))
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumns({name["mask"]: bits, name["text"]: F.unhex(F.sha2(t, 256)), name["part"]: F.coalesce(F.col(part).cast("string"), F.lit("")), name["key"]: F.col(key)})
    rows = rows.select(*[F.col(name[n]).alias(n) for n in ("key", "text", "part", "mask")])
    # Repeated rows of a key are one; null keys, which may be many, are counted by text and never meet a label.
    known = rows.where("key is not null").groupBy("key", "text", "part", "mask").agg(F.count("*").alias("n"))
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    marked = known.join(marks, "key", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # The least key of a text, part and labels, how many rows have it, and how many rows there are.
    grouped = marked.groupBy("text", "part", "mask", "good", "toxic").agg(F.min("key").alias("key"), F.min_by("n", "key").alias("first"), F.sum("n").alias("n"))
    nobody = rows.where("key is null").groupBy("text", "part", "mask").agg(F.count("*").alias("n"))
    nobody = nobody.select("text", "part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"), F.lit(None).cast(docs.schema[key].dataType).alias("key"), F.lit(0).cast("long").alias("first"), "n")
    first = F.min("key").over(Window.partitionBy("text"))
    placed = grouped.withColumn("fresh", F.when(F.col("key") == first, F.col("first")).otherwise(0)).unionByName(nobody.withColumn("fresh", F.col("n")))
    bit = 1 << len(filters)
    split = F.array(F.struct(F.col("mask").alias("mask"), F.col("fresh").alias("n")), F.struct((F.col("mask") + F.lit(bit)).alias("mask"), (F.col("n") - F.col("fresh")).alias("n")))
    cells = placed.select("part", "good", "toxic", F.inline(split)).where("n > 0")
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return cells.groupBy("part", "mask").agg(F.sum("n").alias("all"), count(F.col("good")).alias("good"), count(F.col("toxic")).alias("toxic"))


def audit(masks: DataFrame, names: list[str]) -> DataFrame:
    """For each part, order of the filters and step, what the step's filter does; masks as fail_masks() gives them.

    A part's cells are as many as there are masks, so one row holds them all, and its walk takes memory for its result alone.
    Columns: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.  An empty table
    gives no row.
    """
    n = len(names)
    if not 0 < n <= 8:
        raise ValueError("from one to eight filters can be put in every order")
    common.ship(masks.sparkSession)
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "all", "good", "toxic")).alias("cells"))
    counts = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

    def run(batches):
        for batch in batches:
            for part, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cells = np.zeros((3, 1 << n), np.int64)
                for c in found:
                    cells[:, c["mask"]] = c["all"], c["good"], c["toxic"]
                order, step, *rest = zip(*Walk(cells, n).all_rows(names))
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(order)), pa.array(order), pa.array(step, pa.int32()), *(pa.array(c, pa.int64()) for c in rest)], names=["part", "filter_order", "step", *counts])

    return parts.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in counts))
