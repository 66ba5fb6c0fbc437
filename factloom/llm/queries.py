"""One query for each training-data operator, with production parameters, over its whole table.

A null or empty text counts as an empty one, a null key stays a row, repeated rows each give a row (or count as often, where
rows are counted), further columns do not matter and an empty table gives an empty result; the operators say more.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, cotrain, crosspoly, filteraudit, licences, linecrf, mixing, segtree, simhash, tokens, toolcalls, toxicity
from .common import table


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspoly.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op4_line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return linecrf.judge(docs, linecrf.fit(docs, table(spark, sf_dir, "labels")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixture = mixing.solve(docs, table(spark, sf_dir, "labels"), ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return mixing.assign(docs, mixture).select("doc_id", "domain", "rate", "copies")


def op6_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cotrain.classify(docs, cotrain.fit(docs, table(spark, sf_dir, "labels")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), keep=~toxicity.held_out())
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "n_clauses")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), digest=True)


def tool_turns(turns: DataFrame) -> DataFrame:
    """Every message of a conversation as one of tool use, as the tables have none.

    What a user says becomes an assistant's search for it and a calculation; what the assistant says becomes the result of
    the search one turn before, or of a call that there is not.  Searches wait for calculations of their turn, these for the search two turns before
    and, in some conversations, for that of their own turn, so that there are chains and cycles; some arguments are of a
    wrong type.  Messages of other roles, null ones included, stay as they are, a null text becomes a null argument, and
    repeated rows stay repeated.
    """
    turn, conv = F.col("turn"), F.col("conv_id")
    name = lambda mark, t: F.concat(F.lit(mark), t.cast("string"))
    none = F.array().cast("array<string>")
    search = F.struct(name("s", turn).alias("id"), F.lit("search").alias("name"), F.struct(turn.alias("limit"), F.col("text").alias("query")).alias("arguments"), F.when(turn % 4 < 2, F.array(name("c", turn))).otherwise(none).alias("depends_on"))
    waits = F.concat(F.array(name("s", turn - 2)), F.when(conv % 5 == 0, F.array(name("s", turn))).otherwise(none))
    number = lambda value: F.to_json(F.struct(name("c", turn).alias("id"), F.lit("calculator").alias("name"), F.struct(value.alias("expression")).alias("arguments"), waits.alias("depends_on")))
    ask = F.concat(F.lit('{"tool_calls":['), F.to_json(search), F.lit(","), F.when(turn % 3 == 0, number(turn)).otherwise(number(turn.cast("string"))), F.lit('],"content":"ask"}'))
    answer = F.to_json(F.struct(F.when(turn % 5 == 4, name("x", turn)).otherwise(name("s", turn - 1)).alias("tool_call_id"), F.col("text").alias("content")))
    role = F.col("role")
    return turns.select("conv_id", "turn", F.when(role == "user", "assistant").when(role == "assistant", "tool").otherwise(role).alias("role"), F.when(role == "user", ask).when(role == "assistant", answer).otherwise(F.col("text")).alias("text"))


def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toolcalls.format_messages(tool_turns(table(spark, sf_dir, "conversations")))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), radius=2)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), min_count=10, top=2000)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = filteraudit.text_filters()
    masks = filteraudit.fail_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), filters, copies="E")
    return filteraudit.audit(masks, [*filters, "E"])


def op13_segment_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segtree.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), digest=True)


QUERIES = {
    f.__name__: f
    for f in (
        op1_licence_scan, op2_embedding_near_dedup, op3_token_counts, op4_line_crf_quality, op5_mixing,
        op6_quality_cotraining, op7_toxicity, op8_byte_bpe, op9_tool_calls, op10_simhash_near_dedup,
        op11_phrase_collocations, op12_filter_audit, op13_segment_bpe,
    )
}

#: All pairs by brute force, and reachability by recursion.
_LINKS = """
    WITH RECURSIVE v AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), l AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9
    ), r AS (
        SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
    ), c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a), n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
    SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""

#: tool_turns() and the messages that it gives: links, order by recursion along what calls wait for, and valid arguments.
#: A path of as many steps as there are calls has gone round in a cycle.
_TOOLS = """
    WITH RECURSIVE c AS (
        SELECT conv_id, turn, 0 AS place, 's' || turn AS id, 'search' AS name, '{"limit":' || turn || coalesce(',"query":' || CAST(to_json(text) AS VARCHAR), '') || '}' AS arguments, text IS NOT NULL AS valid,
            CASE WHEN turn % 4 < 2 THEN ['c' || turn] ELSE [] END AS waits FROM conversations WHERE role = 'user'
        UNION ALL
        SELECT conv_id, turn, 1, 'c' || turn, 'calculator', '{"expression":' || CASE WHEN turn % 3 = 0 THEN CAST(turn AS VARCHAR) ELSE '"' || turn || '"' END || '}', turn % 3 <> 0,
            list_concat(['s' || (turn - 2)], CASE WHEN conv_id % 5 = 0 THEN ['s' || turn] ELSE [] END) FROM conversations WHERE role = 'user'
    ), w AS (
        SELECT e.conv_id, e.id, e.awaited FROM (SELECT conv_id, id, unnest(waits) AS awaited FROM c) e JOIN c ON c.conv_id = e.conv_id AND c.id = e.awaited
    ), n AS (SELECT conv_id, count(*) AS n FROM c GROUP BY conv_id
    ), steps AS (
        SELECT conv_id, id, 0 AS d FROM c UNION SELECT w.conv_id, w.id, steps.d + 1 FROM steps JOIN w ON w.conv_id = steps.conv_id AND w.awaited = steps.id JOIN n ON n.conv_id = w.conv_id WHERE steps.d < n.n
    ), deep AS (
        SELECT s.conv_id, s.id, CASE WHEN max(d) < any_value(n) THEN max(d) END AS depth FROM steps s JOIN n USING (conv_id) GROUP BY s.conv_id, s.id
    ), a AS (
        SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN 'x' || turn ELSE 's' || (turn - 1) END AS id, text FROM conversations WHERE role = 'assistant'
    ), r AS (SELECT conv_id, id, min({'turn': turn, 'content': text}) AS first FROM a GROUP BY conv_id, id
    ), written AS (
        SELECT c.conv_id, c.turn, count(*) AS n_calls, count(r.first) AS n_linked, count(*) FILTER (WHERE c.valid) AS n_valid, string_agg('{"arguments":' || c.arguments || ',"depth":' || coalesce(CAST(depth AS VARCHAR), 'null') || ',"id":"' || c.id
            || '","name":"' || c.name || '","result":' || coalesce(CAST(to_json(r.first.content) AS VARCHAR), 'null') || ',"valid":' || c.valid || '}', ',' ORDER BY depth NULLS LAST, place) AS calls
        FROM c JOIN deep ON deep.conv_id = c.conv_id AND deep.id = c.id LEFT JOIN r ON r.conv_id = c.conv_id AND r.id = c.id GROUP BY c.conv_id, c.turn
    )
    SELECT m.conv_id, m.turn, CASE role WHEN 'user' THEN 'assistant' WHEN 'assistant' THEN 'tool' ELSE role END AS role, CAST(coalesce(n_calls, 0) AS BIGINT) AS n_calls, CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked,
        CAST(coalesce(n_valid, 0) AS BIGINT) AS n_valid, role = 'assistant' AND c.id IS NULL AS is_orphan,
        CASE role WHEN 'user' THEN '{"content":"ask","role":"assistant","tool_calls":[' || calls || ']}'
            WHEN 'assistant' THEN '{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"role":"tool","tool_call_id":"' || a_id || '"}'
            ELSE '{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || '}' END AS message
    FROM (SELECT *, CASE WHEN turn % 5 = 4 THEN 'x' || turn ELSE 's' || (turn - 1) END AS a_id FROM conversations) m
    LEFT JOIN written ON role = 'user' AND written.conv_id = m.conv_id AND written.turn = m.turn LEFT JOIN c ON role = 'assistant' AND c.conv_id = m.conv_id AND c.id = a_id
"""

#: Words, then phrases of two and three, cut at every place; all arithmetic in 128-bit whole numbers.
_PHRASES = r"""
    WITH d AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
    ), p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d
    ), o AS (
        SELECT lang, k, w[i:i + k - 1] AS ph FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p), (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w)
    ), f AS (SELECT lang, k, ph, CAST(count(*) AS HUGEINT) AS a FROM o GROUP BY ALL
    ), n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
    ), c AS (SELECT * FROM f WHERE k > 1 AND a >= 10
    ), s AS (SELECT lang, array_to_string(ph, ' ') AS phrase, a FROM f
    ), places AS (SELECT c.*, unnest(range(1, k)) AS j FROM c
    ), halves AS (SELECT *, array_to_string(ph[1:j], ' ') AS head, array_to_string(ph[j + 1:], ' ') AS tail FROM places
    ), cuts AS (
        SELECT h.*, x.a AS l, y.a AS r, (1000000 * h.a * h.a) // (x.a * y.a) AS score FROM halves h JOIN s x ON x.lang = h.lang AND x.phrase = h.head JOIN s y ON y.lang = h.lang AND y.phrase = h.tail
    ), least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, j) = 1
    ), inside AS (SELECT lang, ph[1:2] AS ph, a FROM c WHERE k = 3 UNION ALL SELECT lang, ph[2:3], a FROM c WHERE k = 3
    ), most AS (SELECT lang, ph, max(a) AS longer FROM inside GROUP BY ALL
    ), kept AS (SELECT least.*, array_to_string(least.ph, ' ') AS phrase FROM least LEFT JOIN most USING (lang, ph) WHERE longer IS NULL OR 100 * longer < 50 * a
    ), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

#: Every order by recursion, every step of it counted from scratch.
_AUDIT = r"""
    WITH RECURSIVE marks AS (SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id
    ), w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
    ), m AS (
        SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
            || CASE WHEN 100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 3 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
            || CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
        FROM w LEFT JOIN marks ON marks.doc_id = w.doc_id
    ), cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM m GROUP BY part, fails
    ), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c
    ), orders AS (SELECT '' AS o UNION ALL SELECT o || c FROM orders, letters WHERE NOT contains(o, c)
    ), steps AS (SELECT o, s, o[s] AS c, o[1:s - 1] AS before FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s) WHERE length(o) = 5
    ), x AS (SELECT part, o, s, c, n, good, toxic, contains(fails, c) AS failing, fails = c AS alone, translate(before, fails, '') = before AS here FROM steps, cells
    ), r AS (
        SELECT part, o, s, c, sum(n) FILTER (WHERE here AND NOT failing) AS kept, sum(n) FILTER (WHERE here AND failing) AS removed, sum(n) FILTER (WHERE failing AND NOT here) AS redundant, sum(n) FILTER (WHERE alone) AS alone,
            sum(good) FILTER (WHERE here AND failing) AS good, sum(toxic) FILTER (WHERE here AND failing) AS toxic FROM x GROUP BY part, o, s, c)
    SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(alone, 0) AS BIGINT) AS unique_fails,
        CAST(coalesce(good, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic, 0) AS BIGINT) AS toxic_lost, CAST(coalesce(sum(removed) OVER (PARTITION BY part, c), 0) AS BIGINT) AS shapley FROM r
"""
ORACLES: dict[str, str] = {"op1_licence_scan": licences.oracle(), "op2_embedding_near_dedup": _LINKS, "op9_tool_calls": _TOOLS, "op11_phrase_collocations": _PHRASES, "op12_filter_audit": _AUDIT}
