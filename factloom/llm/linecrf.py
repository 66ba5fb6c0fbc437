"""Quality rules (operator 4): a linear-chain conditional random field labels lines as content or boilerplate.

Labels exist for documents only, so the labels of lines are latent.  Lines of good documents are nearly all content; those
of bad ones are a mixture of both, whose parts are first told apart by how often a line's features occur in either class of
documents.  The field is then fitted to the lines' expected labels by Newton's method, piecewise: over all pairs of
neighbours, as chains of two lines.  (More rounds of expectation maximisation would make the labels of a document's lines
ever more alike, as their class is known: every text then ends as all content or none.)  Executors read whole documents;
the driver gets totals by pairs of feature patterns.  Viterbi decoding labels every line of a text that has a word, and
the share of word characters in content lines decides whether the text is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, learn

SYMBOLS, BLANKS = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
WINDOW = 8
#: Labelled documents used for the fit, with all their lines.
LABELLED_ROWS = 3_000
#: Share of boilerplate among lines of good documents, and at first among those of bad ones.
GOOD_NOISE, BAD_NOISE = 0.02, 0.8
#: Expected counts travel as whole numbers of this part, so that their sums do not depend on the order of tasks.
UNIT = 1_000_000
MIN_SHARE = 0.5
N_FEATURES = 16
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))


def line_mask(words: list[bytes], repeated: bool) -> int:
    """Bit set of a line's features."""
    line = b" ".join(words)
    size, n = len(line), len(words)
    symbols = size - len(line.translate(None, SYMBOLS))
    upper = size - len(line.translate(None, UPPER))
    digits = size - len(line.translate(None, DIGITS))
    shouts = line.count(b"!!")
    echoes = sum(map(bytes.__eq__, words, words[1:]))
    distinct = len(set(words))
    facts = (
        True, n <= 2, 3 <= n <= 8, n > 8, 0 < symbols * 20 <= size, size < symbols * 20 <= 4 * size, symbols * 5 > size, upper * 2 > size,
        shouts * 4 >= n, echoes * 4 >= n and n > 1, distinct * 2 < n, b" | " in line, digits * 5 > size, line[-1:] in b".!?:,;", repeated, size > 24 * n,
    )
    return sum(1 << k for k, fact in enumerate(facts) if fact)


def lines_of(text: str) -> list[tuple[int, int]]:
    """(feature bits, word characters) of each line that has a word."""
    out, seen = [], set()
    for line in text.encode().split(b"\n"):
        words = line.split()
        if words:
            out.append((line_mask(words, line in seen), len(b"".join(words).decode())))
            seen.add(line)
    return out


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that are found twice or more."""
    n = len(words)
    if n <= window or len(set(words)) == n:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, n)
    code = np.zeros(n - window + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(window):
            code = code * np.uint64(0x9E3779B97F4A7C15) + ids[k : n - window + 1 + k] + np.uint64(1)
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    if not same.any():
        return 0
    # Equal codes are only candidates: the windows themselves decide.
    maybe = np.zeros(len(code), bool)
    maybe[order[1:][same]] = maybe[order[:-1][same]] = True
    places: dict[bytes, list[int]] = {}
    for k in np.flatnonzero(maybe).tolist():
        places.setdefault(ids[k : k + window].tobytes(), []).append(k)
    step = np.zeros(n + 1, np.int64)
    for found in places.values():
        if len(found) > 1:
            np.add.at(step, found, 1)
            np.add.at(step, np.array(found) + window, -1)
    return int((np.cumsum(step) > 0).sum())


def base(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = text.encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.translate(None, BLANKS)]
    chars = len(text) - (len(data) - len(data.translate(None, BLANKS)))
    return len(words), chars, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(words)


class Field:
    """Scores of two labels (0 boilerplate, 1 content): by line features, between neighbours, at the start."""

    def __init__(self, emit: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.emit, self.move, self.start = emit, move, start
        self.known: dict[int, tuple[float, float]] = {}

    def emission(self, mask: int) -> tuple[float, float]:
        if (got := self.known.get(mask)) is None:
            on = [k for k in range(N_FEATURES) if mask >> k & 1]
            got = self.known[mask] = (float(self.emit[0, on].sum()), float(self.emit[1, on].sum()))
        return got

    def viterbi(self, masks: list[int]) -> list[int]:
        """The best label sequence; content on ties."""
        if not masks:
            return []
        (bb, bc), (cb, cc) = self.move.tolist()
        b, c = self.emission(masks[0])
        b, c = b + float(self.start[0]), c + float(self.start[1])
        back = []
        for mask in masks[1:]:
            eb, ec = self.emission(mask)
            from_b, from_c = b + bb > c + cb, b + bc > c + cc
            back.append((0 if from_b else 1, 0 if from_c else 1))
            b, c = (b + bb if from_b else c + cb) + eb, (b + bc if from_c else c + cc) + ec
        label = 1 if c >= b else 0
        out = [label]
        for choice in reversed(back):
            label = choice[label]
            out.append(label)
        return out[::-1]

    def share(self, text: str) -> tuple[float, int, int]:
        """Share of word characters in content lines, content lines, lines with a word."""
        lines = lines_of(text)
        labels = self.viterbi([m for m, _ in lines])
        total = sum(n for _, n in lines)
        content = sum(n for (_, n), y in zip(lines, labels) if y)
        return (content / total if total else 0.0), sum(labels), len(lines)


def all_content() -> Field:
    """The field that finds no boilerplate."""
    return Field(np.zeros((2, N_FEATURES)), np.array([[0.0, 1.0], [0.0, 1.0]]), np.array([0.0, 1.0]))


def _bits(masks: np.ndarray) -> np.ndarray:
    return (masks[:, None] >> np.arange(N_FEATURES) & 1).astype(np.float64)


def evidence(good: np.ndarray, bad: np.ndarray, steps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """P(content) of a line by its feature pattern, in bad documents and in good ones.

    `good` and `bad` are how often each pattern occurs in lines of either class.  Each class is a mixture of one content
    and one boilerplate distribution over patterns with its own shares, fitted by expectation maximisation.
    """
    good, bad = good / good.sum(), bad / bad.sum()
    # Patterns as common in good documents as in bad ones start as content; only their part in the mixture moves then.
    junk = bad * (bad / (bad + good)) ** 2 + 1e-6
    content, junk, noise = (good + 1e-6) / (good + 1e-6).sum(), junk / junk.sum(), BAD_NOISE
    for _ in range(steps):
        of_good, of_bad = (p * junk / (p * junk + (1 - p) * content) for p in (GOOD_NOISE, noise))
        junk, content = good * of_good + bad * of_bad + 1e-6, good * (1 - of_good) + bad * (1 - of_bad) + 1e-6
        junk, content, noise = junk / junk.sum(), content / content.sum(), min(max(float(bad @ of_bad), 0.05), 0.95)
    return 1 - of_bad, 1 - of_good


def expected(masks: list[int], known: dict[int, float]) -> dict[tuple[int, int], np.ndarray]:
    """Expected labels of one document: by (-1, features) its first line's, by two neighbours' features theirs.

    A document's lines weigh one in all.
    """
    out: dict[tuple[int, int], np.ndarray] = {}
    p = [known[m] for m in masks]
    first = [((-1, masks[0]), (1 - p[0], p[0], 0.0, 0.0))] if masks else []
    for at, four in first + [((a, b), ((1 - f) * (1 - g), (1 - f) * g, f * (1 - g), f * g)) for a, b, f, g in zip(masks, masks[1:], p, p[1:])]:
        out[at] = out.get(at, 0.0) + np.array(four) / len(masks)
    return out


def fit_counts(first: np.ndarray, second: np.ndarray, counts: np.ndarray, l2: float = 0.1, steps: int = 30) -> Field:
    """The field that makes the counted labels likeliest, by Newton's method.

    Each row has the features of two neighbours and the counts of their labels 00, 01, 10, 11, or, for a first line, -1, its
    features and the counts of its labels 0, 1.
    """
    starts = first < 0
    x = np.zeros((len(first), 4, N_FEATURES + 4))
    a, b = np.where(starts[:, None], 0.0, _bits(np.maximum(first, 0))), _bits(second)
    # Outcomes 00, 01, 10, 11; a first line has the outcomes 0 and 1 alone.
    x[:, 1, :N_FEATURES], x[:, 2, :N_FEATURES], x[:, 3, :N_FEATURES] = b, a, a + b
    for k in (1, 2, 3):
        x[~starts, k, N_FEATURES + k - 1] = 1.0
    x[starts, 1, N_FEATURES + 3] = 1.0
    open_ = np.where(starts[:, None], [0.0, 0.0, -1e9, -1e9], 0.0)
    total, theta = counts.sum(axis=1), np.zeros(N_FEATURES + 4)
    for _ in range(steps):
        z = x @ theta + open_
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = np.einsum("rk,rkf->f", p * total[:, None] - counts, x) + l2 * theta
        mean = np.einsum("rk,rkf->rf", p, x)
        h = np.einsum("rk,rkf,rkg->fg", p * total[:, None], x, x, optimize=True) - (mean * total[:, None]).T @ mean + l2 * np.eye(len(theta))
        move = np.linalg.solve(h, g)
        theta -= move * min(1.0, 5.0 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-7:
            break
    w, t, s = theta[:N_FEATURES], theta[N_FEATURES:-1], theta[-1]
    return Field(np.stack([np.zeros(N_FEATURES), w]), np.array([[0.0, t[0]], [t[1], t[2]]]), np.array([0.0, s]))


def _totals(chains: DataFrame, known: tuple[dict, dict]) -> tuple[np.ndarray, ...]:
    """(class, first features, second features, counts of labels) over all documents, in a fixed order."""

    def run(batches):
        total: dict = {}
        for batch in batches:
            for masks, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for (a, b), four in expected(masks, known[y]).items():
                    total[y, a, b] = total.get((y, a, b), 0) + np.rint(four * UNIT).astype(np.int64)
        keys = np.array(list(total) or np.zeros((0, 3)), np.int32).reshape(-1, 3)
        values = np.array(list(total.values()) or np.zeros((0, 4)), np.int64).reshape(-1, 4)
        yield pa.RecordBatch.from_arrays([*(pa.array(keys[:, k]) for k in range(3)), *(pa.array(values[:, k]) for k in range(4))], names=["y", "a", "b", "n0", "n1", "n2", "n3"])

    rows = chains.select("masks", "y").mapInArrow(run, "y int, a int, b int, n0 long, n1 long, n2 long, n3 long")
    got = rows.groupBy("y", "a", "b").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "n2", "n3"))).toPandas().sort_values(["y", "a", "b"])
    return got["y"].to_numpy(), got["a"].to_numpy(np.int64), got["b"].to_numpy(np.int64), got[["n0", "n1", "n2", "n3"]].to_numpy(np.float64) / UNIT


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS, key: str = "doc_id") -> Field:
    """Field fitted on all lines of at most `rows` documents with a quality label.

    A null text has no lines; of rows with one key one is used, and contradicting labels count as good.  Without labels of
    both classes, or a line of either, every line is content.  Further columns do not matter.
    """
    common.ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            masks = [[m for m, _ in lines_of(t)] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(masks, pa.list_(pa.int32())), batch.column(1)], names=["masks", "y"])

    found = learn.labelled(docs, labels, "quality", rows, key=key).select("text", "y").mapInArrow(run, "masks array<int>, y int")
    chains = common.stored(found.where(F.size("masks") > 0))
    lines = chains.select("y", F.explode("masks").alias("mask"), (F.lit(float(UNIT)) / F.size("masks")).cast("long").alias("n")).groupBy("y", "mask").agg(F.sum("n").alias("n")).toPandas()
    if lines["y"].nunique() < 2:
        return all_content()
    table = lines.pivot(index="mask", columns="y", values="n").fillna(0.0).sort_index()
    masks = table.index.tolist()
    y, first, second, counts = _totals(chains, tuple(dict(zip(masks, p.tolist())) for p in evidence(table[1].to_numpy(np.float64), table[0].to_numpy(np.float64))))
    # Both classes of documents weigh alike, and as many lines as there are documents in all.
    weight = counts.sum() / 2 / np.array([counts[y == k].sum() for k in (0, 1)])
    return fit_counts(first, second, counts * weight[y][:, None])


def judge(docs: DataFrame, field: Field, min_share: float = MIN_SHARE, key: str = "doc_id") -> DataFrame:
    """Counts, base rules and verdict of each row.

    base_failed: fewer than 20 words, or more than 30 % of the words stand in repeated 8-word windows.  kept: base rules hold
    and content lines have at least `min_share` of the word characters.  A null or empty text has no words and fails.
    Repeated rows each give a row; further columns are left out; an empty table gives no row.
    """
    common.ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    names = ["key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share", "n_content_lines", "n_lines"]

    def run(batches):
        for batch in batches:
            for a, b, texts in common.text_slices(batch):
                counts = np.array([base(t) for t in texts], np.int64)
                failed = (counts[:, 0] < 20) | (100 * counts[:, 4] > 30 * counts[:, 0])
                shares = [field.share(t) for t in texts]
                share = np.array([s for s, _, _ in shares])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *(pa.array(counts[:, k]) for k in range(5)), pa.array(failed), pa.array(~failed & (share >= min_share)), pa.array(share), pa.array([s[1] for s in shares], pa.int64()), pa.array([s[2] for s in shares], pa.int64())], names=names,
                )

    schema = f"key {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double, n_content_lines long, n_lines long"
    return docs.select(F.col(key).alias("key"), "text").mapInArrow(run, schema).withColumnRenamed("key", key)
