import hashlib
import itertools
import json
import random
import textwrap

import numpy as np
import pytest

pytest.importorskip("factloom.llm")
import public_tokenizers as P
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from factloom.llm import bpe, licences, linecrf, pretokens, tokens, toolcalls, toxicity

ALPHABET = "abcdeftonrishl'srtlvemd 1٣ \n\t  é!?#²Ⅷ中\x1c\x85😀<|>"
DOCS = [(1, ""), (2, None), (3, "   \n\t "), (4, "don't  stop 'tis 're'll"), (5, "naïve 😀😀 <|endoftext|>x"), (5, "naïve 😀😀 <|endoftext|>x"), (6, "ab" * 40_000), (7, "word " * 20_000), (None, "x\ny")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "clash", 1, True) for k, t in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, fp int, kept boolean")


@pytest.fixture(scope="module")
def rank_encoding():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_tiktoken(P.path("byte_bpe_50k.tiktoken")), special_tokens={})


def texts(seed, n, longest=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_split_is_the_pattern_in_any_chunking():
    pattern, some = regex.compile(P.PATTERN), texts(1, 400)
    for chunk in (2, 3, 7, 128):
        assert pretokens.split(some, chunk) == [[m.encode() for m in pattern.findall(t)] for t in some]


def test_scan_composes_maps():
    maps = np.random.default_rng(0).integers(0, 5, (37, 5)).astype(np.uint8)
    one = np.arange(5)
    for m, got in zip(maps, pretokens.scan(maps)):
        one = m[one]
        assert (one == got).all()


def test_encoding_is_the_librarys(rank_encoding):
    e = bpe.Encoder(bpe.Merges.from_tiktoken(P.path("byte_bpe_50k.tiktoken")), pretokens.split)
    for some in (texts(2, 300), ["a" * 5000, "the quick brown fox " * 50]):
        for t, joined in zip(some, e.encode_joined(some)):
            assert [int(i) for i in joined.split()] == rank_encoding.encode_ordinary(t)
            assert e.decode_joined(joined) == t.encode()


def test_counts_are_the_librarys():
    merges, added = bpe.Merges.from_json(P.path("byte_bpe_50k.json"))
    counter, library = bpe.TokenCounter(merges, added, pretokens.split), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    some = [t + s for t in texts(3, 200) for s in ("", "<|endoftext|>", "<|endoftext|><|endoftext|> x")]
    assert counter.counts(some) == [len(x.ids) for x in library.encode_batch(some, add_special_tokens=False)]


def test_caches_can_be_dropped_at_any_time(monkeypatch, rank_encoding):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 20)
    e = bpe.Encoder(bpe.Merges.from_tiktoken(P.path("byte_bpe_50k.tiktoken")), pretokens.split)
    merges, added = bpe.Merges.from_json(P.path("byte_bpe_50k.json"))
    counter = bpe.TokenCounter(merges, added, pretokens.split)
    for t in texts(4, 60):
        ids = rank_encoding.encode_ordinary(t)
        assert e.encode(t) == ids and counter.counts([t]) == [len(ids)]


def test_prefixes_appends_and_edits():
    rule = bpe.PairRule(bpe.Merges.from_tiktoken(P.path("byte_bpe_50k.tiktoken")))
    rng, data = random.Random(6), b"internationalisation of unbelievable things" * 8
    table = bpe.PrefixTable(rule, data)
    for size in (0, 1, 17, 100):
        assert table.ids(size) == bpe.PrefixTable(rule, data[:size]).ids()
    table.append(b"ness")
    assert table.ids() == bpe.PrefixTable(rule, data + b"ness").ids()
    for _ in range(15):
        a = rng.randrange(len(table.data))
        b, new = min(len(table.data), a + rng.randrange(4)), bytes(rng.choices(b"aeint s", k=rng.randrange(4)))
        table.edit(a, b, new)
        fresh = bpe.PrefixTable(rule, table.data)
        assert table.ids() == fresh.ids() and table.last == fresh.last and table.node == fresh.node
    assert table.edit(5, 6, b"X") < len(table.data)


def test_token_operators_over_a_table(spark, docs, rank_encoding):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = tokens.token_counts(docs, P.path("byte_bpe_50k.json")).collect()
    want = [(k, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for k, t in DOCS]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == sorted(want, key=str) and all(r.over_limit == (r.n_tokens > 512) for r in got)
    got = tokens.encode(docs, P.path("byte_bpe_50k.tiktoken"), digest=True).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(k, sha(" ".join(map(str, rank_encoding.encode_ordinary(t or ""))).encode()), sha((t or "").encode())) for k, t in DOCS]
    assert sorted(((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in got), key=str) == sorted(want, key=str)
    plain = tokens.encode(docs.where("doc_id = 4"), P.path("byte_bpe_50k.tiktoken")).first()
    assert plain.ids == rank_encoding.encode_ordinary(DOCS[3][1]) and bytes(plain.decoded) == DOCS[3][1].encode()
    assert tokens.token_counts(docs.limit(0), P.path("byte_bpe_50k.json")).count() == 0


# Published licence texts and file notices.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

"""
BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n"
BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
GNU = """This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version.

This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details.

You should have received a copy of the GNU {1} along with this {0}. If not, see <https://www.gnu.org/licenses/>."""
AS_IS_ISC = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
LICENCES = {
    "MIT": MIT,
    "BSD-2-Clause": BSD_HEAD + BSD_TAIL,
    "BSD-3-Clause": BSD_HEAD + BSD_NAMES + BSD_TAIL,
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "GPL-3.0-or-later": GNU.format("program", "General Public License", 3),
    "GPL-2.0-or-later": GNU.format("program", "General Public License", 2),
    "LGPL-3.0-or-later": GNU.format("library", "Lesser General Public License", 3),
    "LGPL-2.1-or-later": GNU.format("library", "Lesser General Public License", 2.1),
    "AGPL-3.0-or-later": GNU.format("program", "Affero General Public License", 3),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + AS_IS_ISC,
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n" + AS_IS_ISC,
    "CC0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
}


def layouts(text):
    """A text as it is, wrapped at two widths, as two kinds of comment, and below a heading."""
    wrap = lambda width, lead="": "\n".join(textwrap.fill(p, width, initial_indent=lead, subsequent_indent=lead) if p.strip() else lead.rstrip() for p in text.split("\n\n") for p in (p, "")).rstrip()
    return [text, wrap(72), wrap(50), "/*\n" + wrap(76, " * ") + "\n */\nint x;", wrap(70, "# ") + "\n\nimport os", "Copyright (c) 2020 A. Person\nAll rights reserved.\n\n" + wrap(79) + "\n\nThe end"]


def test_published_licences_in_every_layout(spark):
    rows = [(name, text) for name, whole in LICENCES.items() for text in layouts(whole)]
    df = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in licences.scan(df).collect()}
    assert [(n, k % 6, got[k]) for k, (n, _) in enumerate(rows) if got[k] != n] == []
    assert all(any(m in s for m in licences.MARKS) for s in licences.SENTENCES.values())
    assert all(k in {*licences.SENTENCES, licences.PARTY_ID} for _, ids in licences.RULES for k in ids) and len(set(licences.SENTENCES.values())) == len(licences.SENTENCES)


def test_licences(spark, docs):
    some = ["Intro.\nLicensed under the Apache License, Version 2.0.\nmore", "Released under the MIT License. Released under the MIT License!", "no stop\nlicensed under cc by-nc 4.0\nnor here", "Not licensed under CC BY-NC 4.0.", None, "", MIT + "\n\n" + LICENCES["ISC"], "THE SOFTWARE " + MIT, "\x01licensed under cc by 4.0\x01"]
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    got = [r.licences for r in licences.scan(df).orderBy("doc_id").collect()]
    assert got == ["Apache-2.0", "MIT", "CC-BY-NC-4.0", "", "", "", "MIT,ISC", "", "CC-BY-4.0"]
    assert licences.scan(docs).count() == len(DOCS) and licences.scan(docs.limit(0)).count() == 0


def test_licences_with_parties_and_notices(spark):
    forms = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
    forms += "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n"
    forms += "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
    names = "Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    cases = [
        (forms + names.format("Google Inc."), "BSD-3-Clause"), (forms + names.format("the University of Nowhere"), "BSD-3-Clause"), (forms + names.format("the copyright holder"), "BSD-3-Clause"),
        (forms + "Neither the name of the author may be used for promotion.", "BSD-3-Clause"), (forms, "BSD-2-Clause"), ("// SPDX-License-Identifier: MIT\nint x;", "MIT"), ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-or-later"),
        ("This project is licensed under the MIT License.", "MIT"), ("Released under the Apache License, Version 2.0.", "Apache-2.0"), ("   Apache License\n   Version 2.0, January 2004\n   http://www.apache.org/licenses/\n\nTERMS", "Apache-2.0"),
        ("Neither the name of the rose.", ""), ("The MIT License is short.", ""),
    ]
    got = licences.scan(spark.createDataFrame([(k, t) for k, (t, _) in enumerate(cases)], "doc_id long, text string")).collect()
    assert {r.doc_id: r.licences for r in got} == {k: want for k, (_, want) in enumerate(cases)}


def test_licence_scan_equals_its_sql(spark):
    import duckdb

    rng = random.Random(25)
    pieces = [*licences.SENTENCES.values(), "A line\n", "1. ", ". ", ":\n", "\n\n", "\n", " * ", "!? ", "\x01", "é"]
    some = ["".join(rng.choice(pieces) + rng.choice([" ", "\n", ". "]) for _ in range(rng.randint(1, 12))) for _ in range(300)] + [t for w in LICENCES.values() for t in layouts(w)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").toPandas()
    con = duckdb.connect()
    con.register("documents", df)
    want = con.sql(licences.oracle()).df()
    got = licences.scan(spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")).toPandas()
    rows = lambda d: sorted((int(r.doc_id), r.sentence_ids, r.licences, int(r.n_sentences)) for r in d.itertuples())
    assert rows(got) == rows(want)


def test_repeat_words_and_viterbi_against_brute_force():
    rng = random.Random(7)
    for _ in range(300):
        w = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 40))]
        places = {}
        for k in range(len(w) - 7):
            places.setdefault(tuple(w[k : k + 8]), []).append(k)
        assert linecrf.repeat_words(w) == len({j for p in places.values() if len(p) > 1 for k in p for j in range(k, k + 8)})
    g = np.random.default_rng(0)
    for _ in range(50):
        f = linecrf.Field(g.normal(size=(2, 16)), g.normal(size=(2, 2)), g.normal(size=2))
        masks = [int(x) for x in g.integers(0, 1 << 16, 6)]
        score = lambda y: f.start[y[0]] + sum(f.emission(m)[a] for m, a in zip(masks, y)) + sum(f.move[a, b] for a, b in zip(y, y[1:]))  # noqa: B023, E731
        assert list(max(itertools.product((0, 1), repeat=6), key=score)) == f.viterbi(masks)


def test_line_rules_over_a_table(spark, docs):
    junk = "BUY!! NOW!! CHEAP!! STUFF!!\n" * 3
    prose = "\n".join(f"The {w} report says that rivers and towns near {w} grew in spring." for w in ("north", "south", "east"))
    rows = [(k, junk.replace("NOW", f"NOW{k}") if k % 2 else prose.replace("spring", f"spring {k}")) for k in range(40)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1 - k % 2, 0) for k in range(40)], "doc_id long, quality int, toxic int")
    field = linecrf.fit(train, labels)
    assert field.share(prose)[0] == 1.0 and field.share(junk)[0] == 0.0
    got = {r.doc_id: r for r in linecrf.judge(train, field).collect()}
    assert got[0].kept and not got[0].base_failed and not got[1].kept and got[1].n_dup_lines == 2
    edge = linecrf.judge(docs, field).collect()
    assert len(edge) == len(DOCS) and not any(r.kept for r in edge if r.n_words < 20)
    by_id = {r.doc_id: r for r in edge}
    assert by_id[7].n_repeat_words == 20_000 and by_id[7].base_failed and by_id[2].word_chars == 0 and by_id[6].word_chars == 80_000
    # Without labels every line is content.
    assert linecrf.fit(train, labels.limit(0)).share(junk)[0] == 1.0


def test_grammar_weighs_context():
    s = toxicity.Scorer({"=clod": 2.0, "lowei": 1.0})
    assert s.clauses("he is a clod. fine day") == [pytest.approx(2.0 * toxicity.TARGETED)]
    assert s.clauses("a clod") == [pytest.approx(2.0 * toxicity.BARE)] and s.clauses("loweiblah") == [toxicity.BARE] and s.clauses("lowe") == []
    assert s.clauses("not a clod") == [pytest.approx(2.0 * toxicity.NEGATED * toxicity.BARE)]
    assert s.clauses("she said a clod") == [pytest.approx(2.0 * toxicity.REPORTED * toxicity.TARGETED)]
    assert s.clauses("kill the lights") == [] and s.clauses("kill the lights. you") == []
    assert s.clauses("i will kill you") == s.clauses("i kill all you") == s.clauses("you will kill") == [pytest.approx(toxicity.THREAT_WEIGHT)]
    # Targets that are far off, or beyond a comma, are not the threat's.
    assert s.clauses("you i will kill") == s.clauses("that movie killed it, people loved it") == s.clauses("beat the eggs until they are stiff") == s.clauses("kill, you") == []
    assert s.clauses("i will not kill you") == [pytest.approx(toxicity.THREAT_WEIGHT * toxicity.NEGATED)]
    assert s.clauses("i will kill you, it was said") == [pytest.approx(toxicity.THREAT_WEIGHT * toxicity.REPORTED)]
    assert len(s.clauses("clod clod. clod! x\nclod")) == 3 and s.clauses("") == []


def test_grammar_weighs_insults_by_what_comes_after():
    s = toxicity.Scorer({"=clod": 2.0})
    assert s.clauses("a clod, she said") == [pytest.approx(2.0 * toxicity.TARGETED * toxicity.REPORTED)]
    assert s.clauses("clod that you are") == [pytest.approx(2.0 * toxicity.TARGETED)]
    assert s.clauses("a clod, it was said and said again") == [pytest.approx(2.0 * toxicity.REPORTED * toxicity.BARE)]
    assert s.clauses("not a clod, you clod") == [pytest.approx(2.0 * toxicity.TARGETED * (1 + toxicity.NEGATED))]
    assert s.clauses("kill a clod, you") == [pytest.approx(2.0 * toxicity.TARGETED)]
    # Another clause's words do not count.
    assert s.clauses("a clod. she said") == [pytest.approx(2.0 * toxicity.BARE)]


def test_composed_machine_equals_its_rules_on_all_short_clauses():
    word = {toxicity.OTHER: "stone", toxicity.INSULT: "clod", toxicity.THREAT: "kill", toxicity.TARGET: "you", toxicity.NEGATION: "not", toxicity.REPORT: "said", toxicity.COMMA: ","}
    s = toxicity.Scorer({"=clod": 2.0})
    for n in range(1, 6):
        for clause in itertools.product(word, repeat=n):
            aimed, want = toxicity.TARGET in clause, 0.0
            for k, symbol in enumerate(clause):
                beside = any(clause[j] == toxicity.TARGET and toxicity.COMMA not in clause[min(j, k) : max(j, k)] for j in range(max(0, k - toxicity.REACH), min(n, k + toxicity.REACH + 1)))
                weight = {toxicity.INSULT: 2.0 * (toxicity.TARGETED if aimed else toxicity.BARE), toxicity.THREAT: toxicity.THREAT_WEIGHT * beside}.get(symbol, 0.0)
                if toxicity.NEGATION in clause[max(0, k - toxicity.SCOPE) : k]:
                    weight *= toxicity.NEGATED
                want += weight * (toxicity.REPORTED if toxicity.REPORT in clause else 1.0)
            assert s.clauses(" ".join(word[x] for x in clause)) == ([pytest.approx(want)] if want else [])


@pytest.mark.parametrize(
    "aimed, denied, quoted, threat",
    [
        ("you're a clod", "it didn’t clod", "so it was written a clod", "he was killed"),
        ("du clod", "das ist kein clod", "so wurde berichtet clod", "ich werde dich töten"),
        ("qu'il est clod", "n'est clod", "on raconte clod", "je t'assure je te tuerai"),
        ("eres tú clod", "nunca clod", "lo dijeron clod", "te mataré"),
    ],
)
def test_grammar_in_each_language(aimed, denied, quoted, threat):
    s = toxicity.Scorer({"=clod": 2.0})
    assert s.clauses(aimed) == [pytest.approx(2.0 * toxicity.TARGETED)]
    assert s.clauses(denied) == [pytest.approx(2.0 * toxicity.NEGATED * toxicity.BARE)]
    assert s.clauses(quoted) == [pytest.approx(2.0 * toxicity.REPORTED * toxicity.BARE)]
    assert s.clauses(threat) == [pytest.approx(toxicity.THREAT_WEIGHT)]


def test_scores_depend_on_the_text_alone(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.fit(docs, labels, keep=~toxicity.held_out())
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("y"), "n_chars": F.lit(0)})
    plain = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert {r.doc_id: r.score for r in toxicity.score(other, model).collect()} == plain
    moved = docs.withColumn("doc_id", -F.col("doc_id") - 1)
    assert {-r.doc_id - 1: r.score for r in toxicity.score(moved.drop("lang", "source"), model).collect()} == plain
    again, curve = toxicity.fit(other, labels, keep=~toxicity.held_out())
    assert again == model[0] and np.allclose(curve, model[1])
    assert toxicity.keep(other, model).count() == toxicity.keep(docs, model).count()


def test_toxicity_query_against_a_plain_scorer(spark):
    """Every row of the query, by a scorer that walks the text token by token without the composed machine."""
    from factloom.llm import learn, queries

    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    learned, curve = toxicity.fit(docs, labels, keep=~toxicity.held_out())
    lexicon = toxicity.Lexicon(learned)

    def clause_score(tokens):
        marks = [lexicon[t] or (toxicity.OTHER, 0.0) for t in tokens]
        symbols = [m[0] for m in marks]
        total = 0.0
        for k, (symbol, weight) in enumerate(marks):
            if symbol == toxicity.INSULT:
                weight *= toxicity.TARGETED if toxicity.TARGET in symbols else toxicity.BARE
            elif symbol == toxicity.THREAT:
                weight *= any(symbols[j] == toxicity.TARGET and toxicity.COMMA not in symbols[min(j, k) : max(j, k)] for j in range(max(0, k - toxicity.REACH), min(len(tokens), k + toxicity.REACH + 1)))
            else:
                continue
            if toxicity.NEGATION in symbols[max(0, k - toxicity.SCOPE) : k]:
                weight *= toxicity.NEGATED
            total += weight * (toxicity.REPORTED if toxicity.REPORT in symbols else 1.0)
        return total

    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in queries.op7_toxicity(spark, sf).collect():
        scores, clause = [], []
        for t in [*toxicity.TOKEN.findall(texts[r.doc_id].lower()), "."]:
            if t in toxicity.STOPS:
                scores, clause = scores + [clause_score(clause)], []
            else:
                clause.append(t)
        scores = [x for x in scores if x > 0]
        x = np.array([[np.log1p(sum(scores)), np.log1p(max(scores, default=0.0)), np.log1p(len(scores))]])
        assert r.score == pytest.approx(learn.predict(x, curve)[0], abs=1e-9) and r.n_clauses == len(scores)


def test_toxicity_learns_and_handles_edges(spark, docs):
    rng = random.Random(8)
    words = ["".join(rng.choices("aeioustrn", k=5)) for _ in range(200)]
    rows = [(k, " ".join(rng.choices(words, k=40)) + (" grobian" + rng.choice("abc") + ". a zwort" if k % 4 == 0 else ".")) for k in range(400)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(400)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(train, labels, keep=~toxicity.held_out())
    got = toxicity.score(train, model).collect()
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in got) and all(0 <= r.score <= 1 for r in got)
    edge = toxicity.score(docs, model).collect()
    assert len(edge) == len(DOCS) and all(r.predicted == 0 for r in edge)
    assert toxicity.keep(docs, model).columns == docs.columns and toxicity.keep(docs, model).count() == len(DOCS)
    none = toxicity.fit(train, labels.limit(0))
    assert all(r.predicted == 0 for r in toxicity.score(train.limit(5), none).collect())


def test_rare_certain_insults_outlast_common_chance_words(spark):
    rng = random.Random(13)
    common = ["".join(p) + "xyz" for p in itertools.islice(itertools.product("bdfghklm", repeat=4), 1_400)]
    rows = []
    for k in range(480):
        toxic = k % 8 == 0
        # 5,600 features stand in more toxic documents than others by chance; five documents hold the insult.
        rows.append((k, " ".join(rng.sample(common, 560 if toxic else 350)) + (" zwockel" if toxic and k < 40 else ""), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon, _ = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    toxic, other = 60, 420
    assert lexicon["=zwockel"] == pytest.approx(float(toxicity.surely_higher(np.array([5.0]), np.array([0.0]), toxic, other)[0]))
    # Its beginnings say nothing that it does not say itself.
    assert set(lexicon) == {"=zwockel"}


def test_beginnings_count_by_their_other_words():
    names = ["=loser", "=losing", "lose", "losi", "=grobia", "=grobib", "grob"]
    counts = np.array([[9.0, 0], [1, 8], [10, 3], [1, 8], [4, 0], [5, 0], [9, 0]])
    got = counts - toxicity.commonest_word(names, counts)
    assert got.tolist() == [[9, 0], [1, 8], [1, 3], [0, 0], [4, 0], [5, 0], [4, 0]]


def test_passes_agrees_with_surely_higher(spark):
    rows = [(t, n) for t in range(0, 40) for n in range(0, 60, 3)]
    df = spark.createDataFrame(rows, "t long, n long")
    got = df.select("t", "n", toxicity.passes(F.col("t"), F.col("n"), 90, 400).alias("p")).collect()
    low = toxicity.surely_higher(*np.array([(r.t, r.n) for r in got], np.float64).T, 90, 400)
    assert [r.p for r in got] == list(low > 0) and 0 < (low > 0).sum() < len(rows)


def test_held_out_is_crc32(spark):
    import zlib

    got = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", toxicity.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def brute_depths(calls):
    """Depth of each call id of one conversation; those in or behind a cycle are left out."""
    out = {}
    while True:
        new = {k: 1 + max((out[d] for d in deps if d in calls), default=-1) for k, deps in calls.items() if k not in out and all(d in out for d in deps if d in calls)}
        if not new:
            return out
        out |= new


def test_tool_calls(spark):
    rng, rows, want = random.Random(9), [], {}
    for conv in range(6):
        ids = [f"c{k}" for k in range(5)]
        deps = {i: [rng.choice(ids + ["zz"]) for _ in range(rng.randint(0, 2))] for i in ids}
        calls = [{"id": i, "name": "search", "arguments": {"limit": 1, "query": i} if k % 2 else {"query": 5}, "depends_on": deps[i]} for k, i in enumerate(ids)]
        rows += [(conv, 0, "user", "hi"), (conv, 1, "assistant", json.dumps({"content": "c", "tool_calls": calls}))]
        rows += [(conv, 2 + k, "tool", json.dumps({"tool_call_id": i, "content": f"r{i}"})) for k, i in enumerate(["c0", "c3", "nope"])]
        want[conv] = brute_depths(deps)
    rows += [(None, 0, None, None), (7, 0, "assistant", "{broken"), (7, 0, "assistant", "{broken"), (8, 1, "assistant", "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, message string")
    got = toolcalls.format_messages(df).collect()
    assert len(got) == len(rows)
    for r in got:
        m = json.loads(r.message)
        assert list(m) == sorted(m) or "tool_calls" in m or "tool_call_id" in m
        if r.n_calls:
            assert {c["id"]: c["depth"] for c in m["tool_calls"] if c["depth"] is not None} == want[r.conv_id]
            deep = [c["depth"] if c["depth"] is not None else 99 for c in m["tool_calls"]]
            assert deep == sorted(deep) and (r.n_calls, r.n_linked, r.n_valid) == (5, 2, 2)
            assert {c["id"]: c["result"] for c in m["tool_calls"]} == {"c0": "rc0", "c1": None, "c2": None, "c3": "rc3", "c4": None}
            assert all(list(c["arguments"]) == sorted(c["arguments"]) for c in m["tool_calls"])
    assert sum(r.is_orphan for r in got) == 6
    assert toolcalls.format_messages(df.limit(0)).count() == 0
    assert "Python" not in toolcalls.format_messages(df)._jdf.queryExecution().executedPlan().toString()


def test_tool_arguments(spark):
    cases = [("search", {"query": "q"}, True), ("search", {"query": "q", "limit": 2}, True), ("search", {"query": "q", "limit": "2"}, False), ("search", {"limit": 2}, False), ("search", {"query": "q", "x": 1}, False), ("nope", {}, False), ("fetch", {"url": "u", "headers": {"b": 1}}, True), ("fetch", [1], False), (None, {}, False)]
    df = spark.createDataFrame([(n, json.dumps(a)) for n, a, _ in cases], "n string, a string")
    got = [r.v for r in df.select(toolcalls.valid_arguments(F.col("n"), F.try_parse_json("a"), F.json_object_keys("a"), toolcalls.SCHEMAS).alias("v")).collect()]
    assert got == [v for *_, v in cases]
    assert df.limit(1).select(toolcalls.canonical(F.lit('{"b": 1, "a": {"d": 1, "c": [2, 1]}}')).alias("c")).first().c == '{"a":{"c":[2,1],"d":1},"b":1}'


def test_lines_of_mixed_texts_are_told_apart(spark):
    rng = random.Random(20)
    word = lambda: "".join(rng.choices("aeioustrnlmd", k=rng.randint(3, 8)))
    prose = lambda: " ".join(word() for _ in range(rng.randint(9, 14))).capitalize() + "."
    junk = lambda: " ".join(word().upper() + "!!" for _ in range(rng.randint(9, 14)))
    # Bad documents open with a line of prose; their label says nothing about single lines.
    rows = [(k, "\n".join([prose(), *(junk() if k % 3 == 0 else prose() for _ in range(6))])) for k in range(300)]
    rows.append((300, "\n".join([prose() for _ in range(5)] + [junk() for _ in range(3_000)])))
    train = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k, _ in rows], "doc_id long, quality int")
    field = linecrf.fit(train, labels)
    planted = [prose(), prose(), junk(), junk(), junk(), prose(), prose()]
    assert field.viterbi([m for m, _ in linecrf.lines_of("\n".join(planted))]) == [1, 1, 0, 0, 0, 1, 1]
    got = linecrf.judge(train, field).collect()
    assert all(0 < r.content_share < 1 and r.n_content_lines == 1 for r in got if r.doc_id % 3 == 0 and r.doc_id < 300)
    assert all(r.n_content_lines == 5 and r.n_lines == 3_005 for r in got if r.doc_id == 300)
    # Every line of the long document counts in the fit, and repeated rows do not.
    again = linecrf.fit(train.unionByName(train), labels)
    assert np.array_equal(again.emit, field.emit) and np.array_equal(again.move, field.move)


def test_field_is_the_likeliest_by_brute_force():
    g = np.random.default_rng(21)
    first, second = np.r_[-1, -1, g.integers(0, 1 << 16, 30)], g.integers(0, 1 << 16, 32)
    counts = g.random((32, 4)) * np.where(first[:, None] < 0, [1, 1, 0, 0], 1)
    field = linecrf.fit_counts(first, second, counts)

    def cost(emit, move, start):
        f, out = linecrf.Field(np.stack([np.zeros(16), emit]), np.array([[0, move[0]], move[1:]]), np.array([0.0, start])), 0.0
        for a, b, n in zip(first.tolist(), second.tolist(), counts):
            if a < 0:
                z = [f.start[y] + f.emission(b)[y] for y in (0, 1)]
            else:
                z = [f.emission(a)[x] + f.move[x, y] + f.emission(b)[y] for x in (0, 1) for y in (0, 1)]
            out -= sum(k * (s - np.logaddexp.reduce(z)) for k, s in zip(n, z))
        return out + 0.05 * (emit @ emit + move @ move + start * start)

    emit, move, start = field.emit[1], np.array([field.move[0, 1], *field.move[1]]), field.start[1]
    best = cost(emit, move, start)
    for _ in range(40):
        assert cost(emit + 1e-3 * g.normal(size=16), move + 1e-3 * g.normal(size=3), start + 1e-3 * g.normal()) > best


def test_expected_labels_by_brute_force():
    known = {1: 0.2, 2: 0.9, 3: 0.5}
    masks = [1, 2, 2, 1, 2, 3]
    want = {}
    for labels in itertools.product((0, 1), repeat=6):
        p = np.prod([known[m] if y else 1 - known[m] for m, y in zip(masks, labels)])
        for a, b, k in [(-1, masks[0], labels[0]), *((m, n, 2 * x + y) for m, n, x, y in zip(masks, masks[1:], labels, labels[1:]))]:
            want.setdefault((a, b), np.zeros(4))[k] += p / 6
    got = linecrf.expected(masks, known)
    assert set(got) == set(want) and all(np.allclose(got[k], want[k]) for k in want) and linecrf.expected([], known) == {}


def test_evidence_recovers_a_mixture():
    content, junk = np.array([0.6, 0.3, 0.1, 0.0]), np.array([0.0, 0.1, 0.3, 0.6])
    bad, good = linecrf.evidence(0.99 * content + 0.01 * junk, 0.2 * content + 0.8 * junk)
    assert good[0] > 0.95 and bad[0] > 0.8 and bad[3] < 0.05 and bad[2] < 0.2 and good[2] > bad[2]


def test_chunk_maps_compose_to_the_count_of_the_whole():
    merges, _ = bpe.Merges.from_json(P.path("byte_bpe_50k.json"))
    machine, rng = bpe.CountTransducer(merges), random.Random(22)
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    long = ["".join(rng.choices(a, k=n)) for a, n in (("ab", 3_000), ("aeinrst", 2_000), ("é中x", 900), ("=", 5_000), ("-=", 700), ("abcdefghijklmnopqrstuvwxyz", 1_500))]
    for text in long:
        data = text.encode()
        for chunk in (5, 64, 256):
            n = machine.count_long(data, chunk)
            assert n == machine.run(0, data)[1]
        if text.isascii() and text.isalpha():
            assert n == len(library.encode(text, add_special_tokens=False).ids)
    # Two parts of a text, run from any state, compose.
    data = long[1].encode()
    middle, n = machine.run(0, data[:777])
    assert machine.run(middle, data[777:])[1] + n == machine.run(0, data)[1]


def test_scan_of_partial_maps():
    g = np.random.default_rng(23)
    maps = [{int(s): (int(g.integers(0, 6)), int(g.integers(-2, 5))) for s in g.permutation(6)[: g.integers(1, 7)]} for _ in range(23)]
    for k, got in enumerate(bpe.scan_maps(maps)):
        for start in range(6):
            state, total = start, 0
            for m in maps[: k + 1]:
                if state not in m:
                    state = None
                    break
                state, total = m[state][0], total + m[state][1]
            assert got.get(start) == (None if state is None else (state, total))


def test_changes_of_any_size_stay_apart_from_states():
    # A token of 300 bytes takes the place of 300 others.
    vocab = {bytes((k,)): k for k in range(256)}
    pairs, word = {}, b"a"
    for k in range(299):
        pairs[word, b"b"] = k
        word += b"b"
        vocab[word] = 256 + k
    machine = bpe.CountTransducer(bpe.Merges(vocab, pairs))
    assert machine.run(0, word)[1] == 1 and machine.count_all([word, word + word]) == [1, 2]


def test_depths_by_arrays_and_by_joins_agree_with_brute_force(spark):
    rng, rows, want = random.Random(24), [], {}
    for conv in [*range(8), None]:
        ids = [f"c{k}" for k in range(rng.choice([1, 3, 9, 30]))]
        deps = {}
        for k, i in enumerate(ids):
            chain, any_ = ([ids[k - 1]] if k else []), [rng.choice([*ids, "zz"]) for _ in range(rng.randint(0, 2))]
            deps[i] = (chain, any_, [rng.choice(ids[:k]) for _ in range(rng.randint(0, 3))] if k else [], [ids[(k + 1) % len(ids)]] if k % 5 == 4 else chain)[(conv or 0) % 4]
        rows += [(conv, i, [*d, None, *d]) for i, d in deps.items()]
        want |= {(conv, i): brute_depths(deps).get(i) for i in ids}
    rows.append((99, "lone", None))
    want[99, "lone"] = 0
    df = spark.createDataFrame(rows, "conv long, id string, depends_on array<string>")
    for size in (128, 9, 0):
        assert {(r.conv, r.id): r.depth for r in toolcalls.depths(df, size).collect()} == want


def test_long_chains_of_calls_take_few_rounds(spark, monkeypatch):
    n, written = 1_500, []
    monkeypatch.setattr(toolcalls, "stored", lambda df, put=toolcalls.stored: written.append(1) or put(df))
    df = spark.createDataFrame([(1, f"c{k:04d}", [f"c{k - 1:04d}"]) for k in range(n)], "conv long, id string, depends_on array<string>")
    assert [r.depth for r in toolcalls.depths(df).orderBy("id").collect()] == list(range(n)) and len(written) < 25


def test_calls_of_one_turn_are_told_apart(spark):
    call = lambda name, on: json.dumps({"content": name, "tool_calls": [{"id": "a", "name": name, "arguments": {}, "depends_on": on}, {"id": name, "name": "x", "arguments": None}]})
    for turn in (3, None):
        rows = [(1, turn, "assistant", call("one", ["one"])), (1, turn, "assistant", call("two", [])), (1, 9, "tool", json.dumps({"tool_call_id": "a", "content": "z"})), (1, 9, "tool", json.dumps({"tool_call_id": "a", "content": "b"}))]
        got = [json.loads(r.message) for r in toolcalls.format_messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()]
        # The call that counts is that of the message with the smaller digest, with what that message says it waits for.
        first = min(rows[:2], key=lambda r: hashlib.sha256(r[3].encode()).hexdigest())
        calls = {m["content"]: {c["id"]: c for c in m["tool_calls"]} for m in got if m["role"] == "assistant"}
        chosen = json.loads(first[3])["content"]
        assert calls[chosen]["a"]["depth"] == (1 if chosen == "one" else 0) and calls[chosen]["a"]["result"] == "b"
        other = ({"one", "two"} - {chosen}).pop()
        assert calls[other]["a"]["depth"] is None and calls[other]["a"]["result"] is None


def test_tool_query_links_calls(spark):
    from factloom.llm import queries

    got = queries.op9_tool_calls(spark, "/root/testdata/sf0.001").toPandas()
    assert got.n_calls.sum() > 50 and 0 < got.n_linked.sum() < got.n_calls.sum() and 0 < got.n_valid.sum() < got.n_calls.sum() and got.is_orphan.any()
