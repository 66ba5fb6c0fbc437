"""Mixing sources to target weights (operator 5) with soft membership.

A softmax classifier fitted on a bounded part of the labelled table, drawn by domain, gives each document a posterior over the
domains of the whole table.  Tokens are those of a byte-level BPE vocabulary.  Nonnegative
rates are then found by projected-gradient least squares so that the expected tokens of each domain, the sum over
documents of rate * tokens * posterior, meet their targets: every rate goes against its gradient, its posterior times the
domains' misses, by a fixed step, and is projected to what is allowed.  Steps have Nesterov's momentum, which begins anew where it
leads uphill.  A pass gives the misses, a number for each domain, and all a document's rate needs is its posterior and
the misses of all passes so far; so rates are replayed where they are needed, and no state is kept or moved for documents.
"""

from __future__ import annotations

import functools
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe, common

#: Labelled documents used for the fit; buckets of byte triples.
LABELLED_ROWS, BUCKETS = 4_000, 1_024
#: A solution misses no target by more than this share of all tokens; where none does, the search ends once the sum of squared misses is
#: surely within 2 * GAP of the least one that rates up to the bound, or up to LARGE without one, can have.
TOLERANCE, GAP, LARGE = 1e-5, 4e-7, 10.0
#: Passes over the table after which the search is given up with a warning.  Targets that can be met take some ten at most,
#: others up to some hundreds.
PASSES = 2_000
#: Targets that are not given are the domains' shares of all tokens to this power, made to sum to one.
FLATTEN = 0.7


def features(text: str) -> np.ndarray:
    """Shares of hashed byte triples, square root."""
    b = np.frombuffer(text.encode(), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(BUCKETS, np.float32)
    code = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
    counts = np.bincount((code ^ (code >> np.uint32(15))) % np.uint32(BUCKETS), minlength=BUCKETS)
    return np.sqrt(counts / (len(b) - 2)).astype(np.float32)


@functools.lru_cache(maxsize=2)
def counter(ranks: str | None) -> Callable[[str], int]:
    """Tokens of a text by the library and a rank file (.tiktoken); words between blanks without one."""
    if ranks is None:
        return lambda text: len(text.encode().split())
    encoding = tiktoken.Encoding("mixing", pat_str=PATTERN, mergeable_ranks=bpe.load_tiktoken(ranks), special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Mixture:
    domains: list[str]
    weights: np.ndarray
    targets: np.ndarray
    #: Step length by domain, and for each step the domains' misses and the momentum after it.
    shares: np.ndarray | None = None
    length: float = 1.0
    steps: list[tuple[np.ndarray, float]] = field(default_factory=list)
    #: Largest rate while steps are made, if any; then rates are scaled, and no rate is more than `most`.
    bound: float | None = None
    scale: float = 1.0
    most: float | None = None
    #: Largest miss of a domain's target by these steps, as a share of all tokens, and the sum of squared misses.
    residual: float = 0.0
    squared: float = 0.0
    #: Rank file that tells tokens.
    ranks: str | None = None

    @property
    def converged(self) -> bool:
        return self.residual <= TOLERANCE

    def posterior(self, texts: list[str]) -> np.ndarray:
        x = np.array([features(t) for t in texts], np.float32).reshape(len(texts), BUCKETS)
        return softmax(x @ self.weights[:-1] + self.weights[-1])

    def replay(self, posterior: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rates after all steps and before the last one, where momentum carries them, and where the last step began."""
        now = before = ahead = began = np.ones(len(posterior))
        if self.steps:
            # All gradients at once; a row's own scale makes domains of unlike size converge alike.
            moves = posterior @ np.stack([miss for miss, _ in self.steps], axis=1)
            moves *= (self.length / np.maximum(posterior @ self.shares, 1e-12))[:, None]
            for k, (_, momentum) in enumerate(self.steps):
                before, began = now, ahead
                now = np.clip(ahead - moves[:, k], 0.0, self.bound)
                ahead = now + momentum * (now - before)
        return now, before, ahead, began

    def rates(self, posterior: np.ndarray) -> np.ndarray:
        """Rate of each row."""
        return np.minimum(self.scale * self.replay(posterior)[0], np.inf if self.most is None else self.most)


def quotas(sizes: dict[str, int], rows: int) -> dict[str, int]:
    """`rows` dealt evenly to the domains, what small ones leave to larger ones; each domain gets one at least."""
    out, left = {}, rows
    for k, (d, n) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        out[d] = min(n, max(1, left // (len(sizes) - k)))
        left -= out[d]
    return out


def fit_classifier(x: np.ndarray, y: np.ndarray, k: int, steps: int = 300, rate: float = 0.05, l2: float = 1e-5, weight: np.ndarray | None = None) -> np.ndarray:
    """Softmax regression by Adam; the last row is the intercept.  Row weights have a mean of one."""
    x = np.hstack([x.astype(np.float32), np.ones((len(x), 1), np.float32)])
    truth = np.eye(k, dtype=np.float32)[y]
    c = np.ones((len(x), 1), np.float32) if weight is None else weight.astype(np.float32)[:, None]
    w = np.zeros((x.shape[1], k), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = x.T @ (c * (softmax(x @ w) - truth)) / len(x) + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def solve(docs: DataFrame, labels: DataFrame, domain: str = "lang", targets: dict[str, float] | None = None, total: float | None = None, max_rate: float | None = None, rows: int = LABELLED_ROWS, key: str = "doc_id", ranks: str | None = None) -> Mixture:
    """Classifier, targets and rate steps for docs.

    `targets` are weights by domain; the token total aimed at is `total` times that of docs, by default the same or, with
    a `max_rate`, as much as lets the highest rate be that.  Domains are all values of
    column `domain` in docs; a target for another one is an error.  The classifier is fitted on about `rows` documents, an
    even part of each domain, weighted by the domains' sizes: labelled ones, or any where a domain has none.  Without
    a labelled document every rate is one, and targets are an error.

    Tokens are those of the rank file `ranks`, words between blanks without one.  Targets that cannot be met, as where a
    `total` asks for more than `max_rate` allows, give the rates of the least sum of squared misses, a warning and the residual.
    The classifier, on the driver and in each task, has 1,025 weights a domain, and a pass sends three numbers for each
    domain: some thousands of domains are no trouble, but it is no method for a domain for each document.

    Null domains have no target; null keys are not labelled; of rows with one key and domain one is drawn; a null text is
    empty; ties are broken by key; further columns do not matter; an empty table gives rates of one.
    """
    common.ship(docs.sparkSession)
    named = docs.where(F.col(domain).isNotNull()).withColumns({"key": F.col(key), "domain": F.col(domain).cast("string"), "text": F.coalesce("text", F.lit(""))}).select("key", "domain", "text")
    sizes = {r["domain"]: r["n"] for r in named.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    known = labels.where(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct()
    labelled = named.where(F.col("key").isNotNull()).select("key", "domain").join(known, "key")
    found = {r["domain"]: r["n"] for r in labelled.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(sizes)
    if missing := [d for d in targets or {} if d not in sizes or not found]:
        raise ValueError(f"no document is of {', '.join(missing)}, or none is labelled")
    if not found:
        return Mixture([""], np.zeros((BUCKETS + 1, 1), np.float32), np.ones(1), ranks=ranks)
    # A hash keeps somewhat more than each domain's quota, and the first rows by that hash are ranked to it.
    spare = {d: n for d, n in sizes.items() if d not in found}
    quota = quotas(found | spare, rows)
    chance = F.pmod(F.xxhash64("key"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    plan = docs.sparkSession.createDataFrame([(d, q, min(1.0, (q + 6 * q**0.5 + 20) / (found | spare)[d]), d in found) for d, q in quota.items()], "domain string, quota long, part double, marked boolean")
    near = lambda df, marked: df.join(F.broadcast(plan.where(F.col("marked") == marked)), "domain").where(F.coalesce(chance, F.lit(0.0)) <= F.col("part"))
    first = Window.partitionBy("domain").orderBy(F.xxhash64("key"), "key")
    pick = lambda df: df.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= F.col("quota"))
    few = pick(near(labelled, True)).select("key", "domain").distinct()
    sample = named.join(F.broadcast(few), ["key", "domain"]).groupBy("key", "domain").agg(F.min("text").alias("text"))
    if spare:
        sample = sample.unionByName(pick(near(named, False)).select("key", "domain", "text"))

    def read(batches):
        for batch in batches:
            for a, b, texts in common.text_slices(batch):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array([features(t).astype(np.float16).tobytes() for t in texts], pa.binary())], names=["key", "domain", "x"])

    kind = docs.schema[key].dataType.simpleString()
    drawn = sample.mapInArrow(read, f"key {kind}, domain string, x binary").withColumn("key", F.col("key").cast("string")).toPandas().sort_values(["key", "x"])
    x = np.frombuffer(b"".join(drawn["x"]), np.float16).reshape(len(drawn), BUCKETS)
    y = np.searchsorted(domains, drawn["domain"].to_numpy())
    weight = np.array([sizes[d] for d in domains]) / np.maximum(np.bincount(y, minlength=len(domains)), 1)
    weights = fit_classifier(x, y, len(domains), weight=weight[y] / weight[y].mean())
    k = len(domains)

    mixture = Mixture(domains, weights, np.ones(k) / k, ranks=ranks)

    def members(batches):
        n_tokens = counter(ranks)
        for batch in batches:
            for a, b, texts in common.text_slices(batch):
                p = mixture.posterior(texts)
                yield pa.RecordBatch.from_arrays([pa.array([n_tokens(t) for t in texts], pa.int64()), pa.array([r.tobytes() for r in p.astype(np.float32)], pa.binary()), batch.column(1).slice(a, b - a)], names=["n", "p", "d"])
        # Python workers live on; later tasks should not find the vocabulary still in their memory.
        counter.cache_clear()

    table = common.stored(docs.select("text", F.col(domain).cast("string").alias("d")).mapInArrow(members, "n long, p binary, d string"))
    totals = {r["d"]: r["n"] for r in table.groupBy("d").agg(F.sum("n").alias("n")).collect()}
    share = np.array([totals.get(d) or 0 for d in domains], np.float64)
    aim = np.array([targets.get(d, 0.0) for d in domains]) if targets else (share / max(share.sum(), 1.0)) ** FLATTEN
    mixture.targets = aim / aim.sum() if aim.sum() > 0 else mixture.targets

    def over(function, width: int, most: bool = False) -> np.ndarray:
        """Sum over documents, or the largest, of a few numbers, one row from each task."""

        def run(batches):
            out = np.zeros(width)
            for batch in batches:
                if batch.num_rows:
                    p = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(-1, k).astype(np.float64)
                    got = function(batch.column(0).to_numpy().astype(np.float64), p)
                    out = np.maximum(out, got) if most else out + got
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(out)], names=["k", "s"])

        got = table.select("n", "p").mapInArrow(run, "k int, s double").groupBy("k").agg((F.max if most else F.sum)("s").alias("s")).collect()
        out = np.zeros(width)
        for r in got:
            out[r["k"]] = r["s"]
        return out

    tokens = over(lambda n, p: p.T @ n, k)
    size = tokens.sum()
    if size <= 0:
        return mixture
    mixture.shares = tokens / size
    # Without a total the rates may be scaled as a whole, and so need no bound before that.
    mixture.bound = max_rate if total is not None else None
    goal = mixture.targets * (1.0 if total is None else total)
    # The matrix of second moments has no negative entry, so its largest row sum is no less than its largest eigenvalue.
    mixture.length = 1.0 / max((over(lambda n, p: p.T @ (n / np.maximum(p @ mixture.shares, 1e-12)), k) / size).max(), 1e-12)

    def state(n, p):
        """Expected tokens at the rates and ahead of them; whether momentum went uphill; the gap of the rates one step before."""
        now, before, ahead, began = mixture.replay(p)
        slope = p @ last
        least = np.where(slope > 0, 0.0, LARGE if mixture.bound is None else mixture.bound)
        return np.concatenate([p.T @ (n * now), p.T @ (n * ahead), [(n * (p @ mixture.shares)) @ ((began - now) * (now - before)), (n * slope) @ (before - least)]])

    best, since, passes, last = None, 0, 0, np.zeros(k)
    while True:
        got = over(state, 2 * k + 2) / size
        miss, passes = got[:k] - goal, passes + 1
        if best is None or miss @ miss < best[0]:
            best = (float(miss @ miss), float(np.abs(miss).max()), len(mixture.steps))
        if best[1] <= TOLERANCE or passes > 1 and got[-1] <= GAP or passes >= PASSES:
            break
        if uphill := got[-2] > 0:
            # The momentum of the last step is taken back, so that the next one begins at the rates themselves.
            mixture.steps[-1], since = (mixture.steps[-1][0], 0.0), 0
        since += 1
        mixture.steps.append((miss if uphill else got[k:-2] - goal, (since - 1) / (since + 2)))
        last = miss
    mixture.squared, mixture.residual = best[:2]
    mixture.steps = mixture.steps[: best[2]]
    if max_rate is not None:
        mixture.most = max_rate
        if mixture.bound is None:
            mixture.scale = max_rate / max(over(lambda n, p: np.array([mixture.replay(p)[0].max(initial=0.0)]), 1, most=True)[0], 1e-12)
    if not mixture.converged:
        warnings.warn(f"mixing targets are missed by up to {mixture.residual:.2g} of all tokens", stacklevel=2)
    return mixture


def assign(docs: DataFrame, mixture: Mixture, key: str = "doc_id", text: str = "text", seed: int = 0, count: bool = False) -> DataFrame:
    """docs with domain (the likeliest), rate and copies added, and with `count` n_tokens.

    copies rounds the rate to a whole number without bias, by a hash of the key, so that a rerun decides alike; a null key
    hashes like any value.  A null or empty text has no tokens and the rate of the classifier's prior.  Columns of docs with
    these names are replaced; rows, repeated ones included, all stay; an empty table stays empty.
    """
    common.ship(docs.sparkSession)
    names = ("domain", "rate", *(["n_tokens"] if count else []))

    @F.pandas_udf("domain string, rate double" + ", n_tokens long" * count)
    def member(texts: pd.Series) -> pd.DataFrame:
        texts = [t or "" for t in texts]
        p = np.concatenate([mixture.posterior(texts[a : a + 500]) for a in range(0, len(texts), 500)]) if texts else np.zeros((0, len(mixture.domains)))
        out = {"domain": [mixture.domains[k] for k in p.argmax(axis=1)], "rate": mixture.rates(p)}
        return pd.DataFrame(out | ({"n_tokens": list(map(counter(mixture.ranks), texts))} if count else {}))

    chance = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    added = common.unused(docs, "member")
    out = docs.withColumn(added, member(F.col(text)))
    out = out.withColumns({c: F.col(f"{added}.{c}") for c in names}).drop(added)
    return out.withColumn("copies", (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")).cast("long"))


def draw(docs: DataFrame, mixture: Mixture, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row of docs as many times as its copies say, with its own columns, whatever their names.

    Null texts and keys are dealt with as in assign(); an empty table stays empty.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    assigned = assign(packed, mixture, f"_row.{key}", f"_row.{text}").where("copies > 0")
    return assigned.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("_row.*")
