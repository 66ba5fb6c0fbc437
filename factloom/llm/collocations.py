"""Phrase collocations (operator 11) by vertical positional inverted lists.

Documents are read into segments of bounded size, in which every word has the list of its positions; pieces are set apart, so that a phrase never
runs over their border.  A frequent phrase is extended by merge-joining its occurrences, moved on by its length, with the lists of
adjacent words, and, moved on by one, with the occurrences of the frequent phrases that its rest must be: what both hold is the list of a longer
phrase, and the length of the list is its exact number of occurrences in the segment.  Lengths are added up over all
segments, and phrases that are frequent there go back to their segments for the next extension.

A phrase is one row of a segment at most, however often it occurs, so no word, phrase or language makes a hot key.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Bytes of text whose words make a segment (a longer text is one of its own), and words in one row of its record.
SEGMENT_BYTES, ROW_WORDS = 16_000_000, 250_000
#: A letter A-Z becomes small, a tab a blank, and a stop the byte 0xFF, which no UTF-8 text has.
BREAK = b"\xff"
FOLD = bytes.maketrans(bytes(range(65, 91)) + b"\t.,;:!?\n\x0b\x0c\r", bytes(range(97, 123)) + b" " + BREAK * 10)


class Numbers(dict):
    """Words to numbers in order of first use; a break is -1."""

    def __init__(self):
        super().__init__({BREAK: -1})

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self) - 1
        return n


def folded(texts: list[str]) -> list[bytes]:
    """Words of some texts, and breaks, also between texts."""
    return BREAK.join(t.encode() for t in texts).translate(FOLD).replace(BREAK, b" \xff ").split()


def segments(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """Segments of one language each, as rows of two kinds.

    Words: segment, lang, word, its number there, n (occurrences) and an id that no other row has.  Records (ids is not null):
    segment, number of the record, and the numbers of its words in order, -1 at breaks, as 32-bit integers.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = pa.schema([("segment", pa.int64()), ("number", pa.int32()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("id", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        first = TaskContext.get().partitionId() << 33
        made = {"segment": first, "word": first}
        open_: dict[str, list] = {}

        def flush(name: str):
            numbers, parts, _ = open_.pop(name)
            ids = np.concatenate(parts)
            segment, words = made["segment"], list(numbers)[1:]
            n = np.bincount(ids[ids >= 0], minlength=len(words))
            made["segment"] += 1
            for a in range(0, len(words), 100_000):
                some = words[a : a + 100_000]
                w = len(some)
                yield common.arrow_rows(schema, segment=[segment] * w, number=np.arange(a, a + w, dtype=np.int32), lang=[name] * w, word=[x.decode() for x in some], n=n[a : a + w], id=np.arange(made["word"], made["word"] + w), ids=[None] * w)
                made["word"] += w
            for k, a in enumerate(range(0, len(ids), ROW_WORDS)):
                yield common.arrow_rows(schema, segment=[segment], number=[k], lang=[None], word=[None], n=[None], id=[None], ids=[ids[a : a + ROW_WORDS].tobytes()])

        for batch in batches:
            for a, b, texts in common.text_slices(batch):
                langs = batch.column(0).slice(a, b - a).to_pylist()
                for name in dict.fromkeys(langs):
                    own = [t for t, x in zip(texts, langs) if x == name]
                    numbers, parts, size = open_.setdefault(name, [Numbers(), [], 0])
                    words = folded(own)
                    parts.append(np.fromiter(map(numbers.__getitem__, [*words, BREAK]), np.int32, len(words) + 1))
                    open_[name][2] = size + sum(map(len, own))
                # The largest go first, until what is open is small enough again.
                while sum(x[2] for x in open_.values()) > SEGMENT_BYTES:
                    yield from flush(max(open_, key=lambda x: open_[x][2]))
        for name in list(open_):
            yield from flush(name)

    return rows.mapInArrow(run, "segment long, number int, lang string, word string, n long, id long, ids binary")


class Lists:
    """Positions of phrases of one length: phrase, from 0, and position, in this order."""

    def __init__(self, phrase: np.ndarray, at: np.ndarray, size: int):
        self.phrase, self.at, self.size = phrase, at, size

    @classmethod
    def of_words(cls, ids: np.ndarray, numbers: np.ndarray) -> Lists:
        """Lists of the words whose numbers are given; each becomes its place among these."""
        place = np.full(int(max(ids.max(initial=0), numbers.max(initial=0))) + 2, -1, np.int32)
        place[numbers] = np.arange(len(numbers), dtype=np.int32)
        word = place[ids]
        at = np.flatnonzero(word >= 0)
        order = np.argsort(word[at], kind="stable")
        return cls(word[at][order], at[order].astype(np.int32), 1)

    @functools.cached_property
    def by_position(self) -> tuple[np.ndarray, np.ndarray]:
        """All lists merged: positions in order, and the phrase at each."""
        order = np.argsort(self.at, kind="stable")
        return self.at[order], self.phrase[order]

    def extend(self, words: Lists, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Code (phrase * n_words + word) and position of each occurrence that an adjacent word extends, in this order."""
        found, what = words.by_position
        ahead = joined(found, self.at + self.size)
        hit = ahead >= 0
        if self.size > 1:
            hit &= joined(self.by_position[0], self.at + 1) >= 0
        code = self.phrase[hit].astype(np.int64) * n_words + what[ahead[hit]]
        order = np.argsort(code, kind="stable")
        return code[order], self.at[hit][order]


def joined(found: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value in a sorted row; -1 where it is not in it."""
    if not len(found):
        return np.full(len(wanted), -1, np.int64)
    place = np.minimum(np.searchsorted(found, wanted), len(found) - 1)
    return np.where(found[place] == wanted, place, -1)


def grow(ids: np.ndarray, numbers: np.ndarray, names: np.ndarray, longer: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of a segment that are one word longer than the frequent ones: ids of their words, a row each, and occurrences.

    numbers and names are those of the frequent words; longer has the frequent phrases of two words, three and so on, as
    rows of word ids.
    """
    lists = words = Lists.of_words(ids, numbers)
    by_name = np.argsort(names)
    place = by_name[np.searchsorted(names, np.concatenate([r.ravel() for r in longer]), sorter=by_name)] if longer else names[:0]
    found, levels = np.arange(len(names))[:, None], []
    for rows in longer:
        at, place = place[: rows.size].reshape(rows.shape), place[rows.size :]
        # The code of a phrase is that of its beginning, whose place is known one level up, and its last word.
        begin = at[:, 0]
        for k, codes in enumerate(levels, 1):
            begin = joined(codes, begin * len(names) + at[:, k])
        own = begin * len(names) + at[:, -1]
        order = np.argsort(own)
        levels.append(own[order])
        code, where = lists.extend(words, len(names))
        phrase = joined(levels[-1], code)
        lists, found = Lists(phrase[phrase >= 0], where[phrase >= 0], lists.size + 1), at[order]
    code, _ = lists.extend(words, len(names))
    new, n = np.unique(code, return_counts=True)
    return names[np.hstack([found[new // len(names)], (new % len(names))[:, None]])] if len(new) else np.zeros((0, found.shape[1] + 1), np.int64), n


def _names(size: int) -> list[str]:
    return [f"w{k}" for k in range(1, size + 1)]


def phrases(records: DataFrame, known: DataFrame, size: int) -> DataFrame:
    """(segment, w1, w2 and so on, n): phrases of a size that grow() finds in each segment, which all its rows come to.

    known has the segment's frequent words (size 1, with their number) and shorter phrases (number 0), as ids w1, w2 and so on.
    """
    names = [*_names(size), "n"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("segment", *names)})
        parts = sorted(zip(left.column("number").to_pylist(), left.column("ids").to_pylist()))
        level, number, *w = (right.column(c).to_numpy() for c in ("size", "number", *_names(max(size - 1, 1))))
        longer = [np.stack([c[level == k] for c in w[:k]], axis=1) for k in range(2, size)]
        rows, n = grow(np.frombuffer(b"".join(p for _, p in parts), np.int32), number[level == 1], w[0][level == 1], longer)
        return pa.table([pa.array(np.full(len(n), left.column("segment")[0].as_py(), np.int64)), *(pa.array(rows[:, k]) for k in range(size)), pa.array(n.astype(np.int64))], names=["segment", *names])

    return records.groupBy("segment").cogroup(known.groupBy("segment")).applyInArrow(run, ", ".join(f"{c} long" for c in ("segment", *names)))


def counted(docs: DataFrame, min_count: int, max_words: int, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, words, f) of all frequent phrases, as arrays of one to max_words words, and (lang, n) of all word occurrences."""
    common.ship(docs.sparkSession)
    read = common.stored(segments(docs, lang, text))
    records = read.where("ids is not null").select("segment", "number", "ids")
    each = Window.partitionBy("lang", "word")
    words = read.where("ids is null").select("segment", "number", "lang", "word", "n", "id")
    # A word's id in all segments is the least one that its rows have.
    words = common.stored(words.withColumns({"f": F.sum("n").over(each), "w1": F.min("id").over(each)}).where(F.col("f") >= min_count))
    total = read.where("ids is null").groupBy("lang").agg(F.sum("n").alias("n"))
    named = words.where("id = w1").select(F.col("w1").alias("id"), "lang", "word", "f")
    at = lambda df, size, number: df.select("segment", F.lit(size).alias("size"), number.alias("number"), *[F.col(c) if c in df.columns else F.lit(0).cast("long").alias(c) for c in _names(max(max_words - 1, 1))])
    known, out = at(words, 1, F.col("number")), named.select("lang", F.array("word").alias("words"), "f")
    for size in range(2, max_words + 1):
        rows, w = phrases(records, known, size), _names(size)
        if size < max_words:
            every = Window.partitionBy(*w)
            rows = common.stored(rows.withColumns({"f": F.sum("n").over(every), "least": F.min("segment").over(every)}).where(F.col("f") >= min_count))
            known = known.unionByName(at(rows, size, F.lit(0)))
            rows = rows.where("segment = least").select(*w, "f")
        else:
            rows = rows.groupBy(*w).agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
        for c in w:
            rows = rows.join(named.select(F.col("id").alias(c), F.col("word").alias(f"_{c}"), *(["lang"] if c == w[0] else [])), c).drop(c)
        out = out.unionByName(rows.select("lang", F.array(*[f"_{c}" for c in w]).alias("words"), "f"))
    return common.stored(out), total


def mine(docs: DataFrame, min_count: int = 10, max_words: int = 3, top: int | None = 2000, covered: int = 50, lang: str = "lang", text: str = "text") -> DataFrame:
    """Phrases of two to max_words words that occur min_count times or more, by how much their words keep together.

    Per language (null: und): lang, rank, phrase, a (its occurrences, overlapping ones too), l and r (those of the two parts of
    its cut), n (words in all) and score, floor(1000000 * a * a / (l * r)) of the cut that scores least, of equal ones the
    first.  A phrase inside a longer frequent one that has at least `covered` percent of its occurrences is left out.  Rows
    are ranked by score and a, both descending, then by phrase; only the first `top` of a language are returned, all where it is None.

    A null or empty text has no phrase; repeated rows count as often as they are there; texts of any length are read whole;
    further columns, whatever their names, do not matter; an empty table gives no row.  Products are exact decimals.
    """
    if max_words < 2 or min_count < 1:
        raise ValueError("phrases have two words at least and occur once at least")
    found, total = counted(docs, min_count, max_words, lang, text)
    joined_ = lambda a, b: F.array_join(F.slice("words", a, b), " ")
    every = found.select("lang", F.array_join("words", " ").alias("phrase"), "f")
    long_ = found.where(F.size("words") > 1)
    size = F.size("words")
    # Every place to cut a phrase at.
    cuts = long_.select("*", F.array_join("words", " ").alias("phrase"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "f", "k", joined_(F.lit(1), F.col("k")).alias("left"), joined_(F.col("k") + 1, size - F.col("k")).alias("right"))
    side = lambda name, f: every.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    big = lambda c: f"cast({c} as decimal(19,0))"
    cuts = cuts.withColumn("score", F.expr(f"({big('f')} * {big('f')} * cast(1000000 as decimal(7,0))) div ({big('l')} * {big('r')})"))
    scored = cuts.groupBy("lang", "phrase").agg(F.first("f").alias("a"), F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("x"))
    # Every shorter phrase of two words at least inside a longer one.
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.array_join(F.slice("words", i, m), " "))))
    inside = long_.where(size > 2).select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(F.coalesce(F.col("longer") * 100 < F.col("a") * covered, F.lit(True)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("x.score").desc(), F.col("a").desc(), "phrase"))
    ranked = kept.select("lang", "phrase", "a", "x.l", "x.r", "x.score", place.cast("long").alias("rank"))
    ranked = ranked.where(F.col("rank") <= top) if top is not None else ranked
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
