"""Toxicity (operator 7) by a weighted finite-state grammar over clauses.

A lexicon maps words to symbols: insult, threat, target, negation, reporting or other.  Four transducers - negation scope,
reported speech, targets and scoring - are composed into one deterministic machine, which reads each clause's symbols
and weighs its insults and threats by what stands before and after them.  The grammar's words are those of all its languages at once,
so that a text's score depends on the text alone.  The insults and their weights are learned: words and word
beginnings whose odds among documents labelled toxic are surely higher.  A logistic curve over the clause scores,
fitted on rows that the lexicon it uses has not seen, gives the document's score.
"""

from __future__ import annotations

import collections
import functools
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, learn

# The words of the grammar that are not learned, by language.  Pronouns that are articles in the same
# language (die, le, la) are left out.  A word's part before or after an apostrophe counts where the whole is not listed.
TARGETS = {
    "en": "you your yours yourself yourselves he she they them him her his hers their theirs people folks",
    "de": "du dich dir dein deine deiner deinem deinen deines euch euer eure eurer eurem euren er sie ihn ihm ihr ihnen ihre ihrer ihrem ihren leute menschen",
    "fr": "tu te t' toi ton ta tes tien tienne vous votre vos vôtre il ils elle elles lui leur leurs eux gens",
    "es": "tú tu tus te ti contigo tuyo tuya tuyos tuyas usted ustedes vosotros vosotras vuestro vuestra vuestros vuestras él ella ellos ellas su sus suyo suya gente",
}
NEGATIONS = {
    "en": "not no never neither nor without isn't aren't don't doesn't didn't wasn't weren't won't wouldn't cannot can't couldn't shouldn't hasn't haven't hadn't ain't",
    "de": "nicht nie niemals kein keine keiner keinem keinen keines ohne weder nein",
    "fr": "ne n' pas jamais ni non sans aucun aucune nullement",
    "es": "no nunca jamás ni sin tampoco ningún ninguno ninguna",
}
REPORTS = {
    "en": "said says say saying told tells wrote writes written claimed claims quoted quotes reported reports called calls alleged alleges stated states",
    "de": "sagte sagten sagt sagen gesagt schrieb schrieben schreibt geschrieben erzählte erzählt behauptete behauptet berichtete berichtet nannte nennt genannt zitierte zitiert erklärte erklärt meinte",
    "fr": "dit dite dits disait disaient dire disent écrit écrivit écrivait raconté raconte raconta affirmé affirme affirma déclaré déclare déclara rapporté rapporte rapporta prétendu prétend cité cite appelé appelle",
    "es": "dijo dijeron dice dicen decía decían dicho decir escribió escribe escribieron escrito contó cuenta afirmó afirma afirmado declaró declara declarado informó informa alegó alega citó cita citado llamó llama llamado",
}
THREATS = {
    "en": "kill kills killed killing murder murders murdered murdering hurt hurts hurting destroy destroys destroyed destroying stab stabs stabbed stabbing shoot shoots shot shooting beat beats beaten beating strangle strangles strangled strangling",
    "de": "töten töte tötet tötest tötete getötet umbringen umbringe umbringt umgebracht umzubringen ermorden ermorde ermordet ermordete verletzen verletze verletzt verletzte zerstören zerstöre zerstört zerstörte vernichten vernichte vernichtet erstechen ersteche ersticht erstach erstochen erschießen erschieße erschießt erschoss erschossen schlagen schlage schlägt schlug geschlagen verprügeln verprügle verprügelt erwürgen erwürge erwürgt erwürgte",
    "fr": "tuer tue tues tuent tuerai tuera tuerons tueront tuais tuait tué tuée tués tuées assassiner assassine assassinerai assassinera assassiné blesser blesse blesserai blessera blessé détruire détruis détruit détruirai détruira poignarder poignarde poignarderai poignardera poignardé abattre abats abat abattrai abattra abattu frapper frappe frapperai frappera frappé étrangler étrangle étranglerai étranglera étranglé",
    "es": "matar mato mata matas matan maté mató mataré matará mataremos matarán matado matando asesinar asesino asesina asesinaré asesinará asesinó asesinado herir hiero hiere heriré herirá hirió herido destruir destruyo destruye destruiré destruirá destruyó destruido apuñalar apuñalo apuñala apuñalaré apuñalará apuñaló apuñalado disparar disparo dispara dispararé disparará disparó disparado golpear golpeo golpea golpearé golpeará golpeó golpeado estrangular estrangulo estrangula estrangularé estrangulará estranguló estrangulado",
}
LANGUAGES = tuple(TARGETS)
#: Weight of a threat that names a target.
THREAT_WEIGHT = 4.0
#: Factors of negated, reported and targeted insults, and of those without a target, the report or target before or after
#: them in their clause.  A threat counts with a target beside it, REACH tokens before or after it at most and without a comma between
#: them, and weighs nothing without one.
NEGATED, REPORTED, TARGETED, BARE = 0.3, 0.5, 1.5, 0.5
REACH = 2

#: A threat that waits for its target, and a clause's first and further targets, are symbols between the machines alone.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, COMMA, WAITING, FIRST_TARGET, NEXT_TARGET = range(10)
SYMBOLS = range(COMMA + 1)
#: Tokens that a negation reaches over.
SCOPE = 3
TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)?|[,.!?;\n]")
STOPS = frozenset(".!?;\n")
#: Beginnings of words that may be learned.
PREFIXES = (4, 5, 6)
LABELLED_ROWS = 20_000
CACHE_ENTRIES = 100_000


class Transducer:
    """Deterministic: (state, symbol) to (state, symbol, factor, factor of what came before); an arc not given keeps state and symbol, factors one."""

    def __init__(self, arcs: dict):
        self.arcs = arcs

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, symbol, 1.0, 1.0))


def compose(first: Transducer, second: Transducer, symbols, start=(0, 0)) -> tuple[Transducer, tuple]:
    """The machine that feeds the first one's output to the second, over all reachable pairs of states."""
    arcs, todo, seen = {}, [start], {start}
    while todo:
        state = todo.pop()
        for symbol in symbols:
            a, out, f, before = first.step(state[0], symbol)
            b, out, g, more = second.step(state[1], out)
            arcs[state, symbol] = ((a, b), out, f * g, before * more)
            if (a, b) not in seen:
                seen.add((a, b))
                todo.append((a, b))
    return Transducer(arcs), start


def grammar() -> tuple[dict, tuple]:
    """Composed machine over one clause: (state, symbol) to (state, symbol for the scorer, factor for a hit, factor for the clause so far)."""
    symbols = SYMBOLS
    hits = (INSULT, THREAT)
    negation = Transducer({(k, s): (SCOPE if s == NEGATION else max(k - 1, 0), s, NEGATED if s in hits and k else 1.0, 1.0) for k in range(SCOPE + 1) for s in symbols})
    # The first report or target of a clause also weighs the hits before it.
    report = Transducer({(k, s): (1 if s == REPORT else k, s, REPORTED if s in hits and k else 1.0, REPORTED if s == REPORT and not k else 1.0) for k in (0, 1) for s in symbols})
    # State: whether the clause has had a target, and for how many tokens more the last one is beside a threat.
    arcs: dict = {}
    for seen in (0, 1):
        for near in range(REACH + 1):
            rest = (seen, max(near - 1, 0))
            arcs |= {((seen, near), s): (rest, s, 1.0, 1.0) for s in symbols}
            arcs[(seen, near), INSULT] = (rest, INSULT, TARGETED if seen else BARE, 1.0)
            arcs[(seen, near), THREAT] = (rest, THREAT if near else WAITING, 1.0, 1.0)
            arcs[(seen, near), COMMA] = ((seen, 0), COMMA, 1.0, 1.0)
            arcs[(seen, near), TARGET] = ((1, REACH), NEXT_TARGET if seen else FIRST_TARGET, 1.0, 1.0 if seen else TARGETED / BARE)
    target = Transducer(arcs)
    told = (INSULT, THREAT, COMMA, WAITING, FIRST_TARGET, NEXT_TARGET)
    score = Transducer({(0, s): (0, s if s in told else OTHER, 1.0, 1.0) for s in range(NEXT_TARGET + 1)})
    machine, start = compose(negation, report, symbols)
    machine, start = compose(machine, target, symbols, (start, (0, 0)))
    machine, start = compose(machine, score, symbols, (start, 0))
    return machine.arcs, start


class Lexicon(dict):
    """Word to (symbol, weight); words not seen before are looked up once by themselves and their beginnings."""

    def __init__(self, learned: dict[str, float]):
        super().__init__()
        self.learned = learned
        self.fixed = {w: (s, THREAT_WEIGHT) for s, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)) for n in LANGUAGES for w in words[n].split()}
        self.fixed[","] = (COMMA, 0.0)

    def listed(self, word: str):
        word = word.replace("’", "'")
        got = self.fixed.get(word)
        if got is None and "'" in word:
            head, tail = word.split("'", 1)
            got = self.fixed.get(head + "'") or self.fixed.get(tail) or self.fixed.get(head)
        return got

    def __missing__(self, word: str):
        if len(self) > CACHE_ENTRIES:
            self.clear()
        weight = max([self.learned.get("=" + word, 0.0), *(self.learned.get(word[:k], 0.0) for k in PREFIXES if len(word) >= k)])
        got = self[word] = (INSULT, weight) if weight > 0 else self.listed(word)
        return got


class Scorer:
    def __init__(self, learned: dict[str, float]):
        self.lexicon, (self.arcs, self.start) = Lexicon(learned), grammar()

    def clauses(self, text: str) -> list[float]:
        """Scores of the text's clauses that match."""
        tokens = TOKEN.findall(text.lower())
        marks = list(map(self.lexicon.__getitem__, tokens))
        hits = [k for k, m in enumerate(marks) if m is not None and m[0] in (INSULT, THREAT)]
        out, done = [], 0
        for hit in hits:
            if hit < done:
                continue
            a = hit
            while a > done and tokens[a - 1] not in STOPS:
                a -= 1
            # waiting[i]: threats that came i + 1 tokens ago and have met no target.
            state, total, waiting, k = self.start, 0.0, [0.0] * REACH, a
            while k < len(tokens) and tokens[k] not in STOPS:
                symbol, weight = marks[k] or (OTHER, 0.0)
                state, out_symbol, factor, before = self.arcs[state, symbol]
                total *= before
                fresh = 0.0
                if out_symbol in (FIRST_TARGET, NEXT_TARGET):
                    total, waiting = total + sum(waiting), [0.0] * REACH
                elif out_symbol == COMMA:
                    waiting = [0.0] * REACH
                elif out_symbol == WAITING:
                    fresh = factor * weight
                elif out_symbol in (INSULT, THREAT):
                    total += factor * weight
                elif before != 1.0:
                    waiting = [w * before for w in waiting]
                waiting = [fresh, *waiting[:-1]]
                k += 1
            done = k
            if total > 0:
                out.append(total)
        return out

    def features(self, text: str) -> tuple[float, float, float]:
        c = self.clauses(text)
        return (float(np.log1p(sum(c))), float(np.log1p(max(c, default=0.0))), float(np.log1p(len(c))))


def word_counts(sample: DataFrame) -> DataFrame:
    """(feature, t0, n0, t1, n1): documents of either half, toxic and not, that hold the word (=word) or word beginning."""

    def run(batches):
        counts: dict = collections.defaultdict(lambda: [0, 0, 0, 0])

        def flush():
            names = list(counts)
            values = np.array([counts[n] for n in names], np.int64).reshape(-1, 4)
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array(values[:, k]) for k in range(4))], names=["feature", "t0", "n0", "t1", "n1"])

        for batch in batches:
            for text, y, half in zip(*(batch.column(k).to_pylist() for k in range(3))):
                words = set(TOKEN.findall(text.lower())) - STOPS - {","}
                at = 2 * half + (1 - y)
                for f in {"=" + w for w in words} | {w[:k] for w in words for k in PREFIXES if len(w) >= k}:
                    counts[f][at] += 1
                if len(counts) > CACHE_ENTRIES:
                    yield flush()
        if counts:
            yield flush()

    rows = sample.select("text", "y", "half").mapInArrow(run, "feature string, t0 long, n0 long, t1 long, n1 long")
    return rows.groupBy("feature").agg(*(F.sum(c).alias(c) for c in ("t0", "n0", "t1", "n1")))


def surely_higher(t: np.ndarray, n: np.ndarray, toxic: int, other: int) -> np.ndarray:
    """Lower bound of the log odds ratio of a feature among toxic documents; nought where it is under 1.5 or rests on two."""
    ratio = np.log((t + 0.5) / (toxic - t + 0.5)) - np.log((n + 0.5) / (other - n + 0.5))
    low = ratio - 1.64 * np.sqrt(1 / (t + 0.5) + 1 / (n + 0.5))
    return np.where((low >= 1.5) & (t >= 3), low, 0.0)


def passes(t, n, toxic: int, other: int):
    """As a column, whether surely_higher() gives a weight; features within rounding of its limit pass too."""
    ratio = F.log((t + 0.5) / (F.lit(toxic) - t + 0.5)) - F.log((n + 0.5) / (F.lit(other) - n + 0.5))
    return (t >= 3) & (ratio - 1.64 * F.sqrt(1 / (t + 0.5) + 1 / (n + 0.5)) >= 1.5 - 1e-9)


def commonest_word(features: list[str], counts: np.ndarray) -> np.ndarray:
    """For each word beginning the counts of the commonest word that has it, for a word none.

    A beginning is worth learning only for what other words with it say.
    """
    at = {f: k for k, f in enumerate(features)}
    out, most = np.zeros_like(counts), counts.sum(axis=1)
    for k in sorted((k for f, k in at.items() if f[0] == "="), key=lambda k: (most[k], features[k])):
        for size in PREFIXES:
            if (head := features[k][1 : size + 1]) in at and len(head) == size:
                out[at[head]] = counts[k]
    return out


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS, keep=None, key: str = "doc_id") -> tuple[dict[str, float], np.ndarray]:
    """Learned lexicon and curve.  At most `rows` labelled rows are used; every feature that is surely higher is kept.

    `keep` is a condition on the rows of labels.  Null keys and labels are not used, contradicting labels count as toxic, of
    rows with one key one is used, a null text is empty and further columns do not matter.  Without labels of both classes,
    empty tables included, the lexicon is empty and the curve finds nothing toxic but threats.
    """
    common.ship(docs.sparkSession)
    half = F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(2)).cast("int")
    sample = common.stored(learn.labelled(docs, labels, "toxic", rows, keep, key).withColumn("half", half))
    sizes = {(r["half"], r["y"]): r["n"] for r in sample.groupBy("half", "y").agg(F.count("*").alias("n")).collect()}
    n = lambda h, y: sizes.get((h, y), 0)
    toxic, other = n(0, 1) + n(1, 1), n(0, 0) + n(1, 0)
    if not toxic or not other:
        return {}, np.array([1.0, 1.0, 0.0, -3.0])
    sides = [(F.col("t0") + F.col("t1"), F.col("n0") + F.col("n1"), toxic, other), *((F.col(f"t{h}"), F.col(f"n{h}"), n(h, 1), n(h, 0)) for h in (0, 1))]
    sure = functools.reduce(lambda a, b: a | b, (passes(*side) for side in sides))
    ranked = word_counts(sample).where(sure).toPandas().sort_values("feature")
    names = ranked["feature"].tolist()
    c = ranked[["t0", "n0", "t1", "n1"]].to_numpy(np.float64).reshape(-1, 4)
    rest = c - commonest_word(names, c)

    def table(t: list[int], n: list[int], toxic: int, other: int) -> dict[str, float]:
        low, alone = (surely_higher(x[:, t].sum(axis=1), x[:, n].sum(axis=1), toxic, other) for x in (c, rest))
        return {f: float(w) for f, w, r in zip(names, low, alone) if w > 0 and r > 0}

    unseen = [table([2], [3], n(1, 1), n(1, 0)), table([0], [1], n(0, 1), n(0, 0))]

    def run(batches):
        scorers = [Scorer(w) for w in unseen]
        for batch in batches:
            x = [scorers[h].features(t) for t, h in zip(*(batch.column(k).to_pylist() for k in (0, 1)))]
            yield pa.RecordBatch.from_arrays([batch.column(2), *(pa.array([r[k] for r in x], pa.float64()) for k in range(3))], names=["y", "a", "b", "c"])

    x = sample.select("text", "half", "y").mapInArrow(run, "y int, a double, b double, c double").toPandas()
    curve = learn.logistic(x[["a", "b", "c"]].to_numpy(), x["y"].to_numpy(np.float64), l2=0.1)
    return table([0, 2], [1, 3], toxic, other), curve


def score(docs: DataFrame, model: tuple[dict[str, float], np.ndarray], key: str = "doc_id") -> DataFrame:
    """(key, score, predicted, n_clauses) for each row.

    A null or empty text has no clause and the lowest score.  Repeated rows each give a row; further columns are left out; an
    empty table gives no row.
    """
    common.ship(docs.sparkSession)
    lexicon, curve = model
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        scorer = Scorer(lexicon)
        for batch in batches:
            for a, b, texts in common.text_slices(batch):
                x = np.array([scorer.features(t) for t in texts])
                p = learn.predict(x, curve)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(np.rint(np.expm1(x[:, 2])).astype(np.int32))], names=["key", "score", "predicted", "n_clauses"])

    return docs.select(F.col(key).alias("key"), "text").mapInArrow(run, f"key {kind}, score double, predicted int, n_clauses int").withColumnRenamed("key", key)


def keep(docs: DataFrame, model: tuple[dict[str, float], np.ndarray]) -> DataFrame:
    """The rows of docs that score() does not predict toxic, with all their columns, whatever their names, and without a shuffle.

    Rows with a null or empty text and repeated rows stay; an empty table stays empty.
    """
    common.ship(docs.sparkSession)
    lexicon, curve = model

    @F.pandas_udf("boolean")
    def clean(text: pd.Series) -> pd.Series:
        scorer = Scorer(lexicon)
        return pd.Series(learn.predict(np.array([scorer.features(t or "") for t in text]).reshape(-1, 3), curve) < 0.5)

    return docs.where(clean("text"))


def held_out(key: str = "doc_id"):
    """Whether a row is kept out of learning: crc32 of its key as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))
