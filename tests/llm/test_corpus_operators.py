import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest

pytest.importorskip("factloom.llm")
import public_tokenizers as P
from tokenizers import Tokenizer

from factloom.llm import collocations, filteraudit, queries, segtree

JSON = P.path("byte_bpe_50k.json")
MARK = "<|endoftext|>"
HARD = ["", "a", "  ", "a" * 5000, "​" * 700, f"x{MARK}y{MARK}", MARK * 3, f" {MARK}\n", MARK[:-1], "it's we'll 'LL\n\n\t x", "日本語😀😀", "\x00é́", "ab" * 3000, "!" * 999 + "a"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def encoder():
    return segtree.TreeEncoder(segtree.Ranks(JSON))


# Operator 13


def test_tree_yields_the_leftmost_least():
    rng = random.Random(1)
    for size in (0, 1, 2, 5, 8, 33):
        values = [rng.randrange(4) for _ in range(size)]
        tree = segtree.PairTree(values)
        for _ in range(60):
            value, place = tree.least()
            assert (value, place) == (min(values), values.index(min(values))) if values else value >= segtree.NONE
            if values:
                k = rng.randrange(size)
                values[k] = rng.choice([0, 1, 2, 3, segtree.NONE])
                tree.put(k, values[k])


def test_ids_and_text_are_the_librarys(library, encoder):
    rng = random.Random(2)
    some = HARD + ["".join(rng.choice("abcdeftonrishl'srtlv 1٣\n\té!?中😀<|>") for _ in range(rng.randrange(80))) for _ in range(300)]
    for text, joined in zip(some, encoder.encode_joined(some)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert [int(i) for i in joined.split(b",") if i] == ids
        assert encoder.decode_joined(joined) == library.decode(ids, skip_special_tokens=False)


def test_trees_side_by_side_equal_single_ones(encoder):
    rng = random.Random(3)
    pieces = ["".join(rng.choice("theraino ") for _ in range(rng.randrange(2, 65))).encode() for _ in range(200)]
    ids, sizes = segtree.PairForest(encoder.ranks, pieces).merge_all()
    ends = np.cumsum(sizes)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, sizes)] == [encoder.encode_piece(p) for p in pieces]


def test_bytes_that_are_no_text_decode_as_in_the_library(library, encoder):
    ids = [i for i, b in encoder.ranks.bytes_of.items() if len(b) == 1 and b[0] > 127][:40] + [50256]
    assert encoder.decode_joined(b",".join(b"%d" % i for i in ids)) == library.decode(ids, skip_special_tokens=False)


def test_segment_bpe_over_a_table(spark, library, monkeypatch):
    monkeypatch.setattr(segtree, "CACHE_ENTRIES", 3)
    rows = [(k, t, "clash", 1) for k, t in enumerate([*HARD, None, "same", "same"])] + [(1, "a", "clash", 1), (None, "x", "clash", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for k, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((k, len(ids), sha(",".join(map(str, ids))), sha(t or "")))
    assert sorted(map(tuple, segtree.encode(df, JSON, digest=True).collect()), key=str) == sorted(want, key=str)
    plain = segtree.encode(df, JSON)
    assert plain.columns == ["doc_id", "n_tokens", "ids", "decoded"] and all(len(r.ids) == r.n_tokens for r in plain.collect())
    assert segtree.encode(df.limit(0), JSON).count() == 0


def test_segment_bpe_query_is_the_librarys(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op13_segment_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# Operator 12


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_swaps_meet_every_order_once(n):
    order, seen = list(range(n)), [tuple(range(n))]
    for k in filteraudit.swaps(n):
        order[k], order[k + 1] = order[k + 1], order[k]
        seen.append(tuple(order))
    assert len(seen) == len(set(seen)) == math.factorial(n)


def audit_by_hand(docs, labels):
    """docs: (doc_id, text, lang); every order and step counted document by document."""
    good, toxic = ({k for k, *m in labels if k is not None and m[i] == 1} for i in (0, 1))
    word = re.compile(r"[^\x20\x09-\x0D]+")
    parts = collections.defaultdict(list)
    for k, t, lang in docs:
        t = t or ""
        w = word.findall(t)
        fails = "".join(c for c, bad in zip("ABCD", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), re.search("[#$%&*|]", t))) if bad)
        if k is not None and any(j is not None and j < k and (u or "") == t for j, u, _ in docs):
            fails += "E"
        parts[lang or ""].append((k, fails))
    out = {}
    for part, rows in parts.items():
        shapley = collections.Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = rows
            for s, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                out[part, order, s] = [len(left), len(gone), sum(f in x for _, x in rows) - len(gone), sum(x == f for _, x in rows), sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone), f]
        for key, r in out.items():
            if key[0] == part:
                r[-1] = shapley[r[-1]]
    return {k: tuple(v) for k, v in out.items()}


def test_audit_against_every_order_by_hand(spark):
    rng = random.Random(4)
    texts = ["", None, "a b\x1c c", "# x", "AAA bbb", "word " * 250, " ".join(f"w{i}" for i in range(300)), " ".join(f"W{i}|" for i in range(220)), "é é " * 150]
    docs = [(rng.choice([k, None]) if k % 9 == 0 else k, rng.choice(texts), rng.choice(["en", "de", None, ""])) for k in range(120)]
    docs += docs[:10]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in list(range(0, 120, 2)) * 2] + [(None, 1, 1)]
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, lang string, part string, mask int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    filters = filteraudit.text_filters()
    names = [*filters, "E"]
    got = filteraudit.audit(filteraudit.fail_masks(df, marks, filters, "E"), names)
    rows = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got.collect()}
    assert rows == audit_by_hand(docs, labels) and got.count() == 3 * 600
    # Without labels and without documents.
    assert filteraudit.audit(filteraudit.fail_masks(df, marks.limit(0), filters, "E"), names).agg({"good_lost": "max", "toxic_lost": "max"}).first() == (0, 0)
    assert filteraudit.audit(filteraudit.fail_masks(df.limit(0), marks, filters, "E"), names).count() == 0
    with pytest.raises(ValueError):
        filteraudit.audit(filteraudit.fail_masks(df, marks, filters, "E"), [])


# Operator 11


def phrases_by_hand(docs, min_count, max_words, top, covered=50):
    f = collections.defaultdict(collections.Counter)
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, max_words + 1):
                f[lang or "und"].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        many = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        rows = []
        for p, a in many.items():
            if any(len(q) > len(p) and 100 * b >= covered * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in many.items()):
                continue
            score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.mark.parametrize("max_words, size", [(2, 400), (3, 400), (3, 10**7), (4, 900)])
def test_phrases_against_brute_force(spark, monkeypatch, max_words, size):
    monkeypatch.setattr(collocations, "SEGMENT_BYTES", size)
    monkeypatch.setattr(collocations, "ROW_WORDS", 7)
    rng = random.Random(5)
    words = ["the", "The", "of", "new", "york", "city", "é", "É", "x\x1cy", "\x0b", "a.b", "z,", "中文", "aaa"]
    docs = [(rng.choice(["en", "en", "de", None]), "".join(rng.choice(words[: rng.randrange(3, 14)]) + rng.choice([" ", "\t", "  "]) for _ in range(rng.randrange(60)))) for _ in range(60)]
    docs += [("en", "new york city " * 300), ("en", None), ("fr", ""), ("de", "..!?\n"), ("en", "The The the"), *docs[:5]]
    df = spark.createDataFrame([(k, *d, "clash", 0) for k, d in enumerate(docs)], "doc_id long, lang string, text string, word string, segment int").repartition(3)
    got = sorted(tuple(r) for r in collocations.mine(df, min_count=4, max_words=max_words, top=25).collect())
    assert got == phrases_by_hand(docs, 4, max_words, 25) and len(got) > 20
    assert len(collocations.mine(df, min_count=4, max_words=max_words, top=None).collect()) == len(phrases_by_hand(docs, 4, max_words, None))


def test_phrases_of_nothing(spark):
    df = spark.createDataFrame([(1, None, None), (2, "en", " . ")], "doc_id long, lang string, text string")
    assert collocations.mine(df).count() == collocations.mine(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        collocations.mine(df, max_words=1)


def test_scores_pass_64_bits(spark, monkeypatch):
    found = spark.createDataFrame([("en", ["a"], 4 * 10**12), ("en", ["b"], 4 * 10**12), ("en", ["a", "b"], 3 * 10**12)], "lang string, words array<string>, f long")
    monkeypatch.setattr(collocations, "counted", lambda *a: (found, spark.createDataFrame([("en", 9 * 10**12)], "lang string, n long")))
    assert collocations.mine(found).first().score == 562500
