import random
import warnings

import numpy as np
import pytest

pytest.importorskip("factloom.llm")
from pyspark.sql import functions as F

from factloom.llm import cotrain, crosspoly, graph, mixing, simhash

SF = "/root/testdata/sf0.001"


def roots(ids, linked):
    """Smallest id that each reaches, by repeated relaxation."""
    low = {i: i for i in ids}
    for _ in ids:
        for a, b in linked:
            low[a] = low[b] = min(low[a], low[b])
    return low


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000 + k, 1001 + k) for k in range(30)] + [(5000, 5000 + k) for k in range(1, 300)] + [(None, 1), (3, 3)]
    df = spark.createDataFrame(edges, "src long, dst long")
    good = [(a, b) for a, b in edges if a is not None and a != b]
    want = roots({x for e in good for x in e}, good)
    assert {r.node: r.component for r in graph.components(df).collect()} == want
    assert graph.components(df.limit(0)).count() == 0


def test_forest():
    g = np.random.default_rng(2)
    for _ in range(50):
        n, m = g.integers(1, 30), g.integers(0, 40)
        i, j = g.integers(0, n, m), g.integers(0, n, m)
        assert list(graph.forest(i, j, n)) == [v for _, v in sorted(roots(range(n), list(zip(i.tolist(), j.tolist()))).items())]


def test_simhash_against_brute_force(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(60)]
    base = [[rng.choice(words) for _ in range(80)] for _ in range(25)]
    texts = []
    for b in base:
        texts.append(" ".join(b))
        for _ in range(rng.randrange(4)):
            c = b[:]
            c[rng.randrange(len(c))] = "x"
            texts.append(" ".join(c).upper() if rng.random() < 0.3 else "  ".join(c))
    texts += ["", None, " \n", "one", "One", "one two", texts[0], texts[0]]
    rows = [(k, t, "clash", 0) for k, t in enumerate(texts)] + [(None, texts[0], "clash", 0), (3, texts[3], "clash", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string, fp int")
    fps = [simhash.fingerprint(t or "") for _, t, *_ in rows]
    ids = [r[0] for r in rows]
    near = [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 2]
    group = roots(range(len(rows)), near)
    low = {}
    for k, g in group.items():
        if ids[k] is not None:
            low[g] = min(low.get(g, ids[k]), ids[k])
    want = sorted((str(ids[k]), f"{fps[k]:016x}", low[group[k]]) for k in range(len(rows)))
    got = simhash.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(set(low.values()))
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def plain_fingerprint(text):
    """From the definition alone, on integers."""
    import re

    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_query_against_brute_force(spark):
    from factloom.llm import queries

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fps = {k: plain_fingerprint(t) for k, t in texts.items()}
    near = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    low = roots(sorted(fps), near)
    got = queries.op10_simhash_near_dedup(spark, SF).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted((k, f"{fps[k]:016x}", low[k]) for k in fps)
    for odd in ("A\u00a0B c d", "İ Ä\x1cx y z", "one\x85two three four", "x " * 200_000, "\u2003 a b"):
        assert simhash.fingerprint(odd) == plain_fingerprint(odd)


def test_fingerprint_of_known_shingles():
    import xxhash

    text = "A b\tC d"
    h = [xxhash.xxh64_intdigest(s, 42) for s in ("a b c", "b c d")]
    assert simhash.fingerprint(text) == h[0] & h[1]
    assert simhash.fingerprint("a B") == xxhash.xxh64_intdigest("a b", 42) and simhash.fingerprint(" ") == 0


@pytest.mark.parametrize("tile", [4, 2048])
def test_tiles_lose_no_link(spark, tile):
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(60)}
    fps |= {f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for f in list(fps)[:40]} | {0, 1, 3, 2**64 - 1}
    fps |= {(1 << 20) ^ (1 << k) for k in range(40)}
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    near = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2]
    found = [(r.src % (1 << 64), r.dst % (1 << 64)) for r in simhash.links(df, 2, tile).collect()]
    assert roots(fps, found) == roots(fps, near)


def test_hadamard_is_orthogonal():
    h = crosspoly.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16))


def test_bucket_recall():
    g = np.random.default_rng(5)
    a = crosspoly.normal(g.normal(size=(1500, 64)))
    z = g.normal(size=a.shape)
    z = crosspoly.normal(z - (z * a).sum(1, keepdims=True) * a)
    b = 0.9 * a + np.sqrt(1 - 0.81) * z
    hit = (crosspoly.signatures(a)[:, :, :, None] == crosspoly.signatures(b)[:, :, None, :]).any((1, 2, 3))
    assert hit.mean() > 0.999


@pytest.mark.parametrize("block", [8, 512])
def test_vectors_against_brute_force(spark, block):
    g = np.random.default_rng(6)
    x = g.normal(size=(60, 16))
    x = np.concatenate([x, x[:20] + 0.02 * g.normal(size=(20, 16)), x[:5] * 3, x[:1].repeat(30, 0) + 0.01 * g.normal(size=(30, 16)), x[:1].repeat(12, 0)]).astype(np.float32)
    rows = [(k, v.tolist(), "clash") for k, v in enumerate(x)]
    rows += [(500, None, ""), (501, [0.0] * 16, ""), (502, [float("nan")] * 16, ""), (503, [None] * 16, ""), (504, [], ""), (505, [float("inf")] + [1.0] * 15, ""), (506, [1.0, 2.0], ""), (None, x[0].tolist(), "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links string")
    u = crosspoly.normal(x)
    near = np.argwhere(np.triu(u @ u.T >= 0.9, 1)).tolist()
    low, n = roots(range(len(x)), near), np.zeros(len(x), int)
    for a, b in near:
        n[a] += 1
        n[b] += 1
    got = {r.vec_id: r for r in crosspoly.near_duplicates(df, block=block).collect()}
    assert len(got) == len(rows)
    assert [(got[k].n_links, got[k].component_id, got[k].kept) for k in range(len(x))] == [(n[k], low[k], low[k] == k) for k in range(len(x))]
    assert all(got[k].n_links == 0 and got[k].kept for k in range(500, 507)) and got[None].n_links == 0
    assert crosspoly.near_duplicates(df.limit(0)).count() == 0


def corpus(spark, n=240):
    rng = random.Random(10)
    alphabets = {"en": "etaoin shr", "fr": "éèuaiq lnv", "de": "üßschrn eä"}
    rows = []
    for k in range(n):
        lang = ("en", "en", "en", "fr", "de")[k % 5]
        text = " ".join("".join(rng.choices(alphabets[lang].replace(" ", ""), k=rng.randint(2, 7))) for _ in range(60))
        if k % 6 == 0:
            text = "!! ".join(text.upper().split())
        rows.append((k, text, lang, f"src{k % 3}", len(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame([(k, int(k % 6 != 0), 0) for k in range(0, n, 2)], "doc_id long, quality int, toxic int")


EDGES = [(900, "", None, None, None), (901, None, "xx", "s", -5), (902, "a" * 200_000, "en", "s", 3), (None, "x", "en", "s", 1), (902, "a" * 200_000, "en", "s", 3)]


def test_cotraining(spark):
    docs, labels = corpus(spark)
    model = cotrain.fit(docs, labels)
    got = cotrain.classify(docs, model).collect()
    assert np.mean([r.kept == (r.doc_id % 6 != 0) for r in got]) > 0.98
    kept = cotrain.keep(docs, model)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.kept} and kept.columns == docs.columns
    edges = spark.createDataFrame(EDGES, docs.schema)
    assert cotrain.classify(edges.withColumns({"score": F.lit("clash"), "kept": F.lit(1)}), model).count() == len(EDGES)
    assert cotrain.classify(edges.select("doc_id", "text"), model).count() == len(EDGES) and cotrain.keep(edges.select("doc_id", "text"), model).count() <= len(EDGES)
    nothing = cotrain.fit(docs, labels.limit(0))
    assert cotrain.keep(docs, nothing).count() == docs.count() and cotrain.classify(docs.limit(0), model).count() == 0


def test_cotraining_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    unseen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    model = cotrain.fit(docs, labels.where(~unseen))
    got = cotrain.classify(docs, model).join(labels.where(unseen), "doc_id").toPandas()
    assert len(got) > 60 and (got.kept == (got.quality == 1)).mean() > 0.97
    # Each view is at least as good as before the exchange, and neither weighs against its own verdict.
    first = model["rounds"][0]
    assert len(model["rounds"]) == cotrain.ROUNDS + 1 and (model["blend"][:-1] >= 0).all()
    assert all(min(r[v][0] for r in model["rounds"]) <= first[v][0] for v in first)


def test_blend_weights_are_not_negative():
    g = np.random.default_rng(14)
    y = g.integers(0, 2, 300).astype(float)
    x = np.stack([y + 0.4 * g.normal(size=300), -y + 0.9 * g.normal(size=300)], 1)
    w = cotrain.nonnegative(x, y)
    assert w[0] > 0 and w[1] == 0 and np.allclose(w[[0, 2]], cotrain.learn.logistic(x[:, :1], y, l2=0.1))
    assert cotrain.nonnegative(-x[:, :1], y)[0] == 0
    loss, area = cotrain.measured(x[:, :1], np.array([2.0, -1.0]), y)
    pairs = [(a > b) + 0.5 * (a == b) for a in x[y == 1, 0] for b in x[y == 0, 0]]
    p = 1 / (1 + np.exp(-(2 * x[:, 0] - 1)))
    assert area == pytest.approx(np.mean(pairs)) and loss == pytest.approx(-np.mean(np.log(np.where(y == 1, p, 1 - p))))


def test_cotraining_takes_any_metadata_alike(spark):
    docs, labels = corpus(spark)
    model = cotrain.fit(docs, labels)
    # Such weights that the page view decides.
    model["page"], model["blend"] = np.random.default_rng(15).normal(size=cotrain.N_META + 1) * 3, np.array([0.0, 1.0, 0.0])
    model["curve"]["page"] = np.array([1.0, 0.0])
    rows = [(k, "x y", [None, 5, 7][k % 3], [None, 3, 10_000, -4][k % 4]) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source int, n_chars int").withColumn("score", F.lit("clash"))
    scores = {r.doc_id: r.score for r in cotrain.classify(df, model).collect()}
    middle = sorted(scores.values())[6]
    assert {r.doc_id for r in cotrain.keep(df, model, middle).collect()} == {k for k, s in scores.items() if s >= middle} and len(set(scores.values())) > 4


def test_cotraining_views_share_labels():
    g = np.random.default_rng(11)
    y = g.integers(0, 2, 400)
    content, page = np.stack([y + 0.3 * g.normal(size=400), g.normal(size=400)], 1), np.stack([y + 0.5 * g.normal(size=400)], 1)
    seen = np.where(np.arange(400) < 40, y, -1)
    score, a, b = cotrain.apply_views(cotrain.fit_views(content, page, seen), content, page)
    assert ((score >= 0.5) == y).mean() > 0.93 and ((a >= 0.5) == y).mean() > 0.85 and ((b >= 0.5) == y).mean() > 0.75


def test_cotraining_uses_all_unlabelled_rows(spark, monkeypatch):
    docs, labels = corpus(spark, 4_600)
    few = labels.where("doc_id < 400")
    seen = []
    table = cotrain.Table
    monkeypatch.setattr(cotrain, "Table", lambda t: seen.append(table(t)) or seen[-1])
    model = cotrain.fit(docs.unionByName(docs.where("doc_id = 3")).unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long"))), few)
    # Every row without a label: also the repeated one and the one without a key.
    assert seen[0].size == 4_600 - few.count() + 2
    assert np.mean([r.kept == (r.doc_id % 6 != 0) for r in cotrain.classify(docs, model).collect()]) > 0.98


def test_cotraining_sums_over_a_table_equal_those_in_memory(spark):
    g = np.random.default_rng(12)
    x = g.normal(size=(300, cotrain.N_CONTENT + cotrain.N_META)).astype(np.float16)
    chance = g.random(300)
    views = {"content": x[:, : cotrain.N_CONTENT].astype(np.float32), "page": x[:, cotrain.N_CONTENT :].astype(np.float32)}
    table = cotrain.Table(spark.createDataFrame([(float(c), r.tobytes()) for c, r in zip(chance, x)], "chance double, x binary").repartition(3))
    rows, models = cotrain.Rows(views, chance), {v: 0.5 * g.normal(size=a.shape[1] + 1) for v, a in views.items()}
    counts = rows.counts([], models, 0.95)
    assert counts and table.counts([], models, 0.95) == counts and table.size == 300
    quota = {1: 20, 0: 10}
    history = [{o: (v, models[v], cotrain._cuts(counts, o, quota)) for v, o in (("content", "page"), ("page", "content"))}]
    np.testing.assert_allclose(table.sums(history, models), rows.sums(history, models), rtol=1e-3, atol=1e-3)
    got = cotrain.pseudo_labels(views, chance, history)
    for v, other in (("content", "page"), ("page", "content")):
        z = views[v] @ models[v][:-1] + models[v][-1]
        for label, sign in ((1, 1), (0, -1)):
            sure = np.sort(np.flatnonzero(sign * z >= np.log(19))[np.argsort(-(sign * z)[sign * z >= np.log(19)])][: quota[label]])
            assert abs(len(set(sure) ^ set(np.flatnonzero(got[other] == label)))) <= 2
    assert cotrain._cuts({("page", 1, 5000): 4, ("page", 1, 4000): 10}, "page", {1: 9, 0: 1}) == {1: (4000, 0.5), 0: (1 << 40, 0.0)}


def test_mixing_meets_targets(spark):
    docs, labels = corpus(spark)
    targets = {"en": 0.4, "fr": 0.3, "de": 0.3}
    m = mixing.solve(docs, labels, targets=targets)
    a = mixing.assign(docs, m, count=True).toPandas()
    got = {d: (a.rate * a.n_tokens)[a.lang == d].sum() / a.n_tokens.sum() for d in targets}
    assert m.converged and (a.rate >= 0).all() and all(abs(got[d] - t) < 0.03 for d, t in targets.items())
    assert (abs(a.copies - a.rate) < 1).all()
    capped = mixing.assign(docs, mixing.solve(docs, labels, targets=targets, max_rate=1.0), count=True).toPandas()
    assert (capped.rate <= 1).all() and (capped.copies <= 1).all() and capped.rate.max() > 0.9
    share = capped.assign(w=capped.rate * capped.n_tokens).groupby("lang").w.sum()
    assert all(abs(share[d] / share.sum() - t) < 0.03 for d, t in targets.items())
    clash = docs.withColumns({"rate": F.lit("mine"), "copies": F.lit("too"), "_member": F.lit(1), "member": F.lit(2), "MEMBER_": F.lit(3)})
    assert mixing.assign(clash, m).columns == [*docs.columns, "rate", "copies", "_member", "member", "MEMBER_", "domain"]
    rows = mixing.draw(clash, m)
    assert rows.count() == a.copies.sum() and rows.columns == clash.columns and rows.first().rate == "mine"
    again = mixing.assign(docs, mixing.solve(docs, labels, targets=targets)).toPandas()
    assert dict(zip(a.doc_id, a.copies)) == dict(zip(again.doc_id, again.copies))


def test_mixing_covers_all_domains_by_tokens(spark):
    docs, labels = corpus(spark, 300)
    # English documents are longer, French ones are all unlabelled, one German one is among few labels.
    docs = docs.withColumn("text", F.when(F.col("lang") == "en", F.repeat(F.concat("text", F.lit(" ")), 3)).otherwise(F.col("text")))
    fr = [r.doc_id for r in docs.where("lang = 'fr'").collect()]
    some = labels.where(~F.col("doc_id").isin(fr))
    m = mixing.solve(docs, some, rows=9)
    assert m.domains == ["de", "en", "fr"]
    n = docs.select("lang", F.size(F.split(F.trim("text"), " ")).alias("n")).groupBy("lang").sum("n").collect()
    assert mixing.counter(None)("a b  c") == 3
    share = np.array([dict(n)[d] for d in m.domains]) ** mixing.FLATTEN
    np.testing.assert_allclose(m.targets, share / share.sum(), rtol=1e-6)
    assert (mixing.assign(docs, m).where("lang = 'fr' and domain = 'fr'").count()) > 30
    assert mixing.quotas({"a": 1, "b": 100, "c": 1000}, 41) == {"a": 1, "b": 20, "c": 20} and mixing.quotas({"a": 5, "b": 5}, 1) == {"a": 1, "b": 1}


def test_mixing_against_plain_least_squares(spark):
    import public_tokenizers as P
    import tiktoken

    from factloom.llm import bpe

    folder, ranks = "/root/testdata/sf0.01", P.path("byte_bpe_50k.tiktoken")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    m = mixing.solve(docs, labels, max_rate=1.0, ranks=ranks)
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_tiktoken(ranks), special_tokens={})
    a = docs.toPandas().sort_values("doc_id")
    n = np.array([len(encoding.encode_ordinary(t or "")) for t in a.text], float)
    got = mixing.assign(docs, m, count=True).toPandas().sort_values("doc_id")
    assert got.n_tokens.tolist() == n.tolist()
    # The documents' rates meet the targets, and their total is nearly the largest that the bound allows.
    p = m.posterior([t or "" for t in a.text]).astype(np.float32).astype(float)
    reached = p.T @ (n * got.rate) / n.sum()
    assert np.abs(reached / reached.sum() - m.targets).max() < 5 * mixing.TOLERANCE and m.converged and got.rate.between(0, 1).all()
    most = (p.T @ n / n.sum() / m.targets).min()
    assert 0.9 * most < reached.sum() <= most * 1.001
    with pytest.warns(UserWarning, match="missed"):
        assert not mixing.solve(docs, labels, total=3.0, max_rate=1.0).converged


@pytest.mark.parametrize("domain, total, max_rate", [("lang", 1.4, 1.2), ("source", 1.3, 1.1), ("source", None, None)])
def test_mixing_reaches_the_least_squared_miss(spark, domain, total, max_rate):
    """Targets that cannot be met, few and many domains: the squared miss is that of a long plain projected gradient search."""
    folder = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        m = mixing.solve(docs, labels, domain=domain, total=total, max_rate=max_rate)
    texts = [r.text or "" for r in docs.collect()]
    n = np.array([len(t.encode().split()) for t in texts], float)
    a = (n / n.sum())[:, None] * m.posterior(texts).astype(np.float32).astype(float)
    goal = m.targets * (1.0 if total is None else total)
    miss = a.T @ m.replay(m.posterior(texts).astype(np.float32).astype(float))[0] - goal
    assert m.squared == pytest.approx(miss @ miss, abs=1e-9) and len(m.domains) == (4 if domain == "lang" else 20)
    rates, length = np.ones(len(n)), 1 / np.linalg.norm(a, 2) ** 2
    for _ in range(30_000):
        rates = np.clip(rates - length * (a @ (a.T @ rates - goal)), 0, max_rate)
    best = a.T @ rates - goal
    assert m.squared <= best @ best + 1e-6 and m.converged == (m.residual <= mixing.TOLERANCE)


def test_mixing_edges(spark):
    docs, labels = corpus(spark, 60)
    m = mixing.solve(docs, labels)
    edges = spark.createDataFrame(EDGES, docs.schema).withColumn("rate", F.lit("clash"))
    got = mixing.assign(edges, m, count=True).collect()
    assert len(got) == len(EDGES) and all(r.rate >= 0 for r in got) and {r.n_tokens for r in got if r.doc_id in (900, 901)} == {0}
    with pytest.raises(ValueError, match="zz"):
        mixing.solve(docs, labels, targets={"zz": 1.0})
    none = mixing.solve(docs.limit(0), labels)
    assert mixing.assign(docs.limit(0), none).count() == 0
    assert all(r.rate == 1 for r in mixing.assign(docs, mixing.solve(docs, labels.limit(0))).collect())


def test_pipeline(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now, sizes = docs, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, SF)
        if k < 4:
            assert now.columns == docs.columns
            now = corpus_pipeline.stored(now)
            sizes.append(now.count())
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < docs.count()
    out = now.toPandas()
    assert len(out) == sizes[-1] and out.doc_id.is_unique
    whole = corpus_pipeline.run(spark, SF).toPandas()
    assert sorted(map(tuple, whole.to_numpy())) == sorted(map(tuple, out.to_numpy()))


def test_stored_tables_can_be_dropped(spark):
    import os

    from factloom.llm import common

    common.drop_stored(spark)
    (path,) = {os.path.dirname(f.removeprefix("file://")) for f in common.stored(spark.range(3)).inputFiles()}
    assert os.path.isdir(path) and common.drop_stored(spark) == 1 and not os.path.isdir(path)


def test_session_is_as_before_after_release(spark):
    from factloom.llm import common

    common.release(spark)
    spark.conf.set(common.BATCH_ROWS, "5000")
    common.ship(spark)
    common.ship(spark)
    assert spark.conf.get(common.BATCH_ROWS) == str(common.MAX_BATCH_ROWS)
    common.release(spark)
    assert spark.conf.get(common.BATCH_ROWS) == "5000"
    spark.conf.unset(common.BATCH_ROWS)


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace as N

    from factloom.llm import common

    unset = N(get=lambda *_: None)
    session = lambda master: N(conf=unset, sparkContext=N(master=master, getConf=lambda: unset, getCheckpointDir=lambda: None, setCheckpointDir=lambda _: None))
    with pytest.raises(common.NoSharedFolder):
        common.shared_dir(session("spark://host:7077"))
    common.shared_dir(session("local[2]"))


def test_pipeline_of_odd_tables(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    odd = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.lit("x") for c in ("_n", "n", "_place", "place", "_member", "member", "_rank", "id", "key", "fp", "component_id", "copies", "score", "row", "y")})
    more = odd.limit(5)
    nulls = [odd.limit(3).withColumn(c, F.lit(None).cast(odd.schema[c].dataType)) for c in ("text", "doc_id", "lang", "source", "n_chars")]
    docs = odd.unionByName(more).unionByName(more)
    for extra in (*nulls, odd.limit(1).withColumn("text", F.repeat(F.lit("the word of a long text. "), 40_000)).withColumn("doc_id", F.lit(10**9))):
        docs = docs.unionByName(extra)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").unionByName(spark.createDataFrame([(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")).write.parquet(f"{tmp_path}/labels.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        columns = now.columns
        now = corpus_pipeline.stored(stage(spark, now, str(tmp_path)))
        assert k == 4 or now.columns == columns
    assert now.where("doc_id is not null").count() == now.where("doc_id is not null").select("doc_id").distinct().count() > 50


def test_pipeline_of_nothing(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    now = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.stored(stage(spark, now, SF))
    assert now.count() == 0
