"""Quality classifier (operator 6) by co-training.

One view is what the text is made of, whatever its size; the other is the page's metadata alone: language, source and the
stated number of characters.  Each view has a logistic classifier.  In every round each names the unlabelled documents that it is surest of, in the classes' own
proportion, as labels for the other.  All unlabelled documents take part: which of them have got a label follows from the
rounds' models and cuts, so no state is kept for a document, and tasks send sums of gradients and Hessians.  Each view keeps the model of the round that did best on labelled documents kept
out of its training, on which it is then calibrated; a logistic blend of the two calibrated views, neither with a negative
weight, scores all documents.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, learn

#: Labelled documents used for the fit; unlabelled ones all are.
LABELLED_ROWS = 4_000
ROUNDS, CONFIDENT = 4, 0.95
#: A pseudo-label weighs a quarter of a label.
PSEUDO_WEIGHT = 0.25
#: Bins of a log odds unit, in which confident documents are ranked; parts in which sums travel.
BINS, PARTS = 1_024, 16
METADATA = ("lang", "source", "n_chars")
#: Byte classes: blank, line end, lower, upper, digit, then each mark that junk is made of, other marks, other bytes.
MARKS = b"!#$%&*|<>="
N_CLASSES = 7 + len(MARKS)
N_META = 8 + 32 + 13


def _byte_classes() -> np.ndarray:
    table = np.full(256, 6, np.int64)
    table[:128] = 5
    for chars, kind in ((b" \t\r\x0b\x0c", 0), (b"\n", 1), (bytes(range(97, 123)), 2), (bytes(range(65, 91)), 3), (bytes(range(48, 58)), 4)):
        table[list(chars)] = kind
    for k, c in enumerate(MARKS):
        table[c] = 7 + k
    return table


BYTE_CLASS = _byte_classes()
N_CONTENT = N_CLASSES * N_CLASSES + 5


def content_view(text: str) -> np.ndarray:
    """Shares of byte-class pairs, and how much words repeat."""
    out = np.zeros(N_CONTENT, np.float32)
    data = text.encode()
    kinds = BYTE_CLASS[np.frombuffer(data, np.uint8)]
    if len(kinds) > 1:
        pairs = np.bincount(kinds[:-1] * N_CLASSES + kinds[1:], minlength=N_CLASSES * N_CLASSES)
        out[:-5] = np.sqrt(pairs / (len(kinds) - 1))
    words = data.split()
    n = len(words)
    if n:
        lines = [x for x in data.split(b"\n") if x.strip()]
        echo = sum(map(bytes.__eq__, words, words[1:])) / n
        size = len(b"".join(words)) / n
        out[-5:] = (len(set(words)) / n, echo, float(echo > 0.25), size / 10, 1 - len(set(lines)) / max(len(lines), 1))
    return out


def page_view(lang, source, n_chars) -> np.ndarray:
    """Language, source and stated length; a null, a NaN or a negative length is a value of its own."""
    out = np.zeros(N_META, np.float32)
    out[zlib.crc32(str(lang).encode()) % 8] = 1
    out[8 + zlib.crc32(str(source).encode()) % 32] = 1
    known = n_chars is not None and np.isfinite(n_chars) and n_chars >= 0
    out[40 + (min(11, int(np.log2(1 + n_chars) * 0.7)) if known else 12)] = 1
    return out


def _odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x.astype(np.float64) @ w[:-1] + w[-1], -40, 40)


def _bins(z: np.ndarray) -> np.ndarray:
    return np.floor(z * BINS).astype(np.int64)


def pseudo_labels(views: dict, chance: np.ndarray, history: list) -> dict:
    """Label of each row for either view, -1 where there is none, after the rounds of the history.

    A round gives for the view that learns: the other one, its model, and for labels 1 and 0 the bin from which on rows
    are taken, with the share of that bin's own rows.
    """
    labels = {v: np.full(len(chance), -1) for v in views}
    for turn in history:
        for learner, (v, w, cuts) in turn.items():
            z, free = _odds(views[v], w), labels[learner] < 0
            for label, sign in ((1, 1), (0, -1)):
                q, (at, part) = _bins(sign * z), cuts[label]
                labels[learner][free & ((q > at) | ((q == at) & (chance < part)))] = label
    return labels


def confident_counts(views: dict, chance: np.ndarray, history: list, models: dict, confident: float) -> dict:
    """(learning view, label, bin): number of rows without a label for that view of which the other one is sure."""
    least = int(np.ceil(_logit(np.float64(confident)) * BINS))
    labels, out = pseudo_labels(views, chance, history), {}
    for v, learner in (("content", "page"), ("page", "content")):
        z = _odds(views[v], models[v])[labels[learner] < 0]
        for label, sign in ((1, 1), (0, -1)):
            q, n = np.unique(_bins(sign * z), return_counts=True)
            out |= {(learner, label, int(a)): int(b) for a, b in zip(q, n) if a >= least}
    return out


def newton_sums(views: dict, chance: np.ndarray, history: list, models: dict) -> np.ndarray:
    """Gradient and Hessian of the pseudo-labelled rows' loss for each view in models, one after the other."""
    labels, out = pseudo_labels(views, chance, history), []
    for v, w in models.items():
        on = labels[v] >= 0
        x = np.hstack([views[v][on].astype(np.float32), np.ones((int(on.sum()), 1), np.float32)])
        p = learn.sigmoid(x.astype(np.float64) @ w)
        half = x * np.sqrt(p * (1 - p)).astype(np.float32)[:, None]
        out += [x.T.astype(np.float64) @ (p - labels[v][on]), (half.T @ half).astype(np.float64).ravel()]
    return np.concatenate(out)


class Rows:
    """Unlabelled rows in memory."""

    def __init__(self, views: dict, chance: np.ndarray):
        self.views, self.chance, self.size = views, chance, len(chance)

    def counts(self, *args) -> dict:
        return confident_counts(self.views, self.chance, *args)

    def sums(self, *args) -> np.ndarray:
        return newton_sums(self.views, self.chance, *args)


class Table:
    """Unlabelled rows (chance, x) of a table: the same figures, of which the driver gets the totals."""

    def __init__(self, table: DataFrame):
        self.table, self.size = table, table.count()

    def counts(self, *args) -> dict:
        def run(batches):
            total: dict = {}
            for batch in batches:
                for k, n in confident_counts(*_unpacked(batch), *args).items():
                    total[k] = total.get(k, 0) + n
            columns = list(zip(*((*k, n) for k, n in total.items()))) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.int64()))], names=["learner", "label", "bin", "n"])

        got = self.table.mapInArrow(run, "learner string, label int, bin long, n long").groupBy("learner", "label", "bin").agg(F.sum("n").alias("n")).collect()
        return {(r["learner"], r["label"], r["bin"]): r["n"] for r in got}

    def sums(self, *args) -> np.ndarray:
        def run(batches):
            total = None
            for batch in batches:
                if batch.num_rows:
                    s = newton_sums(*_unpacked(batch), *args)
                    total = s if total is None else total + s
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([s.tobytes() for s in np.array_split(total, PARTS)], pa.binary())], names=["part", "s"])

        def add(rows: pa.Table) -> pa.Table:
            s = sum(np.frombuffer(b, np.float64) for b in rows["s"].to_pylist())
            return pa.table({"part": rows["part"][:1], "s": pa.array([s.tobytes()], pa.binary())})

        got = self.table.mapInArrow(run, "part int, s binary").groupBy("part").applyInArrow(add, "part int, s binary").collect()
        return np.concatenate([np.frombuffer(r["s"], np.float64) for r in sorted(got, key=lambda r: r["part"])])


def _unpacked(batch: pa.RecordBatch) -> tuple[dict, np.ndarray]:
    x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float16).reshape(batch.num_rows, N_CONTENT + N_META).astype(np.float32)
    return {"content": x[:, :N_CONTENT], "page": x[:, N_CONTENT:]}, batch.column(0).to_numpy()


def _cuts(counts: dict, learner: str, quota: dict) -> dict:
    """For labels 1 and 0: the bin that the surest `quota` rows reach down to, and the share of its rows that they take."""
    out = {}
    for label, left in quota.items():
        found = sorted(((at, n) for (v, k, at), n in counts.items() if (v, k) == (learner, label)), reverse=True)
        out[label] = (1 << 40, 0.0)
        for at, n in found:
            out[label] = (at, min(1.0, left / n))
            left -= n
            if left <= 0:
                break
    return out


def _fit_models(views: dict, y: np.ndarray, pool, history: list, start: dict, l2: float = 1.0, steps: int = 25) -> dict:
    """Both ridge logistic classifiers over labelled rows and the pool's pseudo-labelled ones, by Newton's method."""
    models, active = {v: w.copy() for v, w in start.items()}, list(views)
    x = {v: np.hstack([a, np.ones((len(a), 1))]) for v, a in views.items()}
    for _ in range(steps):
        now = {v: models[v] for v in active}
        more, at = pool.sums(history, now), 0
        for v, w in now.items():
            k = len(w)
            g, h = more[at : at + k], more[at + k : at + k + k * k].reshape(k, k)
            at += k + k * k
            ridge = np.full(k, l2)
            ridge[-1] = 1e-3
            p = learn.sigmoid(x[v] @ w)
            g = PSEUDO_WEIGHT * g + x[v].T @ (p - y) + ridge * w
            h = PSEUDO_WEIGHT * h + (x[v] * (p * (1 - p))[:, None]).T @ x[v] + np.diag(ridge + 1e-9)
            move = np.linalg.solve(h, g)
            models[v] = w - move * min(1.0, 5.0 / max(np.abs(move).max(), 1e-12))
            if np.abs(move).max() < 1e-3:
                active.remove(v)
        if not active:
            break
    return models


def fit_views(content: np.ndarray, page: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, confident: float = CONFIDENT, pool=None) -> dict:
    """Both classifiers, their calibrations and the blend.  y is 1, 0, or -1 where there is no label; `pool` has further rows without one.

    "rounds" tells each view's log loss and area under the curve on the kept-out labelled rows, before the first exchange and
    after each.
    """
    views = {"content": content.astype(np.float64), "page": page.astype(np.float64)}
    known = np.flatnonzero(y >= 0)
    if len(known) == 0 or len(np.unique(y[known])) < 2:
        # One class or none: nothing is rejected.
        return {"content": np.zeros(content.shape[1] + 1), "page": np.zeros(page.shape[1] + 1), "curve": {"content": np.array([0.0, 5.0]), "page": np.array([0.0, 5.0])}, "blend": np.array([1.0, 0.0, 0.0]), "rounds": []}
    if pool is None:
        free = np.flatnonzero(y < 0)
        pool = Rows({v: x[free] for v, x in views.items()}, (np.arange(len(free)) + 0.5) / max(len(free), 1))
    # Every fourth labelled row is for calibration.
    kept_out = known[::4]
    train = np.setdiff1d(known, kept_out) if len(np.unique(y[np.setdiff1d(known, kept_out)])) == 2 else known
    seen, truth = {v: x[train] for v, x in views.items()}, y[train].astype(np.float64)
    share = truth.mean()
    quota = {label: int(pool.size / rounds * part) + 1 for label, part in ((1, share), (0, 1 - share))}
    held, target = {v: x[kept_out] for v, x in views.items()}, y[kept_out].astype(np.float64)
    models, history = {v: learn.logistic(x, truth) for v, x in seen.items()}, []
    best, rounds_of = dict(models), [{v: measured(held[v], models[v], target) for v in views}]
    for _ in range(rounds if pool.size else 0):
        counts = pool.counts(history, models, confident)
        history.append({learner: (v, models[v], _cuts(counts, learner, quota)) for v, learner in (("content", "page"), ("page", "content"))})
        models = _fit_models(seen, truth, pool, history, models)
        now = {v: measured(held[v], models[v], target) for v in views}
        for v in views:
            if now[v][0] < min(r[v][0] for r in rounds_of):
                best[v] = models[v]
        rounds_of.append(now)
    z = {v: _logit(learn.predict(held[v], best[v])) for v in views}
    curve = {v: learn.logistic(s[:, None], target, l2=0.01) for v, s in z.items()}
    return best | {"curve": curve, "blend": nonnegative(np.stack([_logit(learn.predict(z[v][:, None], curve[v])) for v in views], axis=1), target), "rounds": rounds_of}


def measured(x: np.ndarray, w: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(mean log loss, area under the curve) of a model on labelled rows; the area is NaN for one class alone."""
    p = np.clip(learn.predict(x, w), 1e-9, 1 - 1e-9)
    order, n1 = np.unique(p, return_inverse=True)[1], y.sum()
    size = np.bincount(order)
    rank = (np.cumsum(size) - (size - 1) / 2)[order]
    area = (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1)) if 0 < n1 < len(y) else float("nan")
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()), float(area)


def nonnegative(x: np.ndarray, y: np.ndarray, l2: float = 0.1) -> np.ndarray:
    """Ridge logistic weights of which none but the intercept is negative: columns that would be are left out."""
    on = list(range(x.shape[1]))
    while True:
        w = learn.logistic(x[:, on], y, l2=l2)
        if (w[:-1] >= 0).all():
            out = np.zeros(x.shape[1] + 1)
            out[on], out[-1] = w[:-1], w[-1]
            return out
        on.pop(int(np.argmin(w[:-1])))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def apply_views(model: dict, content: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, content view, page view): probabilities of good quality."""
    p = [learn.predict(_logit(learn.predict(x.astype(np.float64), model[v]))[:, None], model["curve"][v]) for v, x in (("content", content), ("page", page))]
    return learn.predict(np.stack([_logit(q) for q in p], axis=1), model["blend"]), *p


def _meta(docs: DataFrame) -> list:
    """The metadata columns, each in one type whatever the table has; a missing one is null."""
    kinds = {"n_chars": "double"}
    return [(F.col(c) if c in docs.columns else F.lit(None)).try_cast(kinds.get(c, "string")).alias(c) for c in METADATA]


def _rows(docs: DataFrame, key: str, *more) -> DataFrame:
    return docs.select(F.col(key).alias("key"), *_meta(docs), F.coalesce("text", F.lit("")).alias("text"), *more)


def _views(batch: pa.RecordBatch, a: int, b: int, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    meta = zip(*(batch.column(batch.schema.get_field_index(c)).slice(a, b - a).to_pylist() for c in METADATA))
    return np.array([content_view(t) for t in texts]), np.array([page_view(*m) for m in meta])


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS, key: str = "doc_id") -> dict:
    """Model from at most `rows` labelled documents, chosen by a hash of their key, and all rows whose key has no label.

    Null keys and labels are not labels, contradicting ones count as good, of rows with one labelled key one is used; a
    null text is empty, null or missing metadata are values of their own, further columns do not matter.  Without labels of
    both classes, empty tables included, the model rejects nothing.
    """
    common.ship(docs.sparkSession)
    quality = labels.where(F.col(key).isNotNull() & F.col("quality").isin(0, 1)).groupBy(F.col(key).alias("key")).agg(F.max("quality").cast("int").alias("y"))
    # A hash keeps somewhat more than are needed, so that not all keys are sorted.
    n = quality.count()
    chance = F.pmod(F.xxhash64("key"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    near = quality.where(chance <= min(1.0, (rows + 6 * rows**0.5 + 20) / max(n, 1)))
    few = common.checkpointed(near.orderBy(chance, "key").limit(rows))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rest = [batch.column(k) for k in range(batch.num_columns) if batch.schema.names[k] in ("key", "y")]
            for a, b, texts in common.text_slices(batch):
                x = [np.concatenate(r).astype(np.float16).tobytes() for r in zip(*_views(batch, a, b, texts))]
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in rest), pa.array(x, pa.binary())], names=[*("key", "y")[: len(rest)], "x"])

    found = learn.one_each(_rows(docs, key).join(F.broadcast(few), "key")).mapInArrow(run, f"key {kind}, y int, x binary").withColumn("key", F.col("key").cast("string")).toPandas().sort_values(["key", "x"])
    x = np.frombuffer(b"".join(found["x"]), np.float16).reshape(len(found), N_CONTENT + N_META).astype(np.float32)
    y = found["y"].to_numpy()
    if len(np.unique(y)) < 2:
        return fit_views(x[:, :N_CONTENT], x[:, N_CONTENT:], y)
    chance = F.pmod(F.xxhash64(F.lit(6), "key", "x"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    free = _rows(docs, key).mapInArrow(run, f"key {kind}, x binary").join(labels.select(F.col(key).alias("key")), "key", "left_anti")
    pool = Table(common.stored(free.select(chance.alias("chance"), "x")))
    return fit_views(x[:, :N_CONTENT], x[:, N_CONTENT:], y, pool=pool)


def classify(docs: DataFrame, model: dict, threshold: float = 0.5, key: str = "doc_id") -> DataFrame:
    """(key, score, content_score, page_score, kept) for each row; kept = score >= threshold.

    A null text is empty; null or missing metadata are values of their own.  Repeated rows each give a row; further columns
    are left out; an empty table gives no row.
    """
    common.ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, b, texts in common.text_slices(batch):
                p = apply_views(model, *_views(batch, a, b, texts))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(x) for x in p), pa.array(p[0] >= threshold)], names=["key", "score", "content_score", "page_score", "kept"])

    return _rows(docs, key).mapInArrow(run, f"key {kind}, score double, content_score double, page_score double, kept boolean").withColumnRenamed("key", key)


def keep(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that classify() keeps, with all their columns, whatever their names, and without a shuffle.

    A null text is empty; null or missing metadata are values of their own.  Repeated rows are judged alike; an empty table
    stays empty.
    """
    common.ship(docs.sparkSession)

    @F.pandas_udf("boolean")
    def good(lang: pd.Series, source: pd.Series, n_chars: pd.Series, text: pd.Series) -> pd.Series:
        texts = [t or "" for t in text]
        meta = [[None if x is None or x != x else x for x in m] for m in zip(lang, source, n_chars)]
        out = [np.zeros(0, bool)]
        for a in range(0, len(texts), 1000):
            part = texts[a : a + 1000]
            views = np.array([content_view(t) for t in part]), np.array([page_view(*m) for m in meta[a : a + 1000]])
            out.append(apply_views(model, *views)[0] >= threshold)
        return pd.Series(np.concatenate(out))

    return docs.where(good(*_meta(docs), F.col("text")))
