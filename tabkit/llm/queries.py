"""One query per operator over the test tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.llm import bytepairs, chat, extract, langid, lexical, lines, nearest, ngramjoin, packing, periodic, quality, transducer, urls
from tabkit.queries.registry import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


LINES_SQL = """
WITH l AS (SELECT doc_id, text, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS pos, unnest(ls) AS line, ls
  FROM (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
w AS (SELECT doc_id, pos, list_slice(ls, pos + 1, pos + 3) AS win FROM l WHERE pos + 3 <= len(ls)),
f AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS k FROM w
  WHERE trim(win[1] || win[2] || win[3], ' ') <> ''),
c AS (SELECT DISTINCT doc_id, pos + d AS pos FROM f, (SELECT unnest([0, 1, 2]) AS d) WHERE k > 1),
j AS (SELECT l.doc_id, l.pos, l.line, c.pos IS NOT NULL AS gone FROM l LEFT JOIN c ON l.doc_id = c.doc_id AND l.pos = c.pos),
g AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM j GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, g.text FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id
"""


@query("op1_line_dedup", LINES_SQL)
def op1_line_dedup(spark, sf):
    return lines.dedup_lines(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", "text")


WORD_FILE, RANK_FILE = "word_bpe_49k.json", "byte_bpe_multi_50k.tiktoken"
CONTEXT, SEQUENCE, END_ID = 2048, 4096, 1


@query("op2_token_counts")
def op2_token_counts(spark, sf):
    return transducer.count_tokens(table(spark, sf, "documents"), public_tokenizers.path(WORD_FILE), CONTEXT)


@query("op3_language_id")
def op3_language_id(spark, sf):
    return langid.identify_languages(table(spark, sf, "documents").select("doc_id", "text", "lang"))


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

URLS_SQL = """
WITH rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u AS (SELECT row_number() OVER () AS rid, page_id,
  coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages)
SELECT page_id, host, path, h || p AS rule, coalesce(v, 'allow') AS verdict FROM u
LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(h || p) DESC) = 1
"""


@query("op4_url_filter", URLS_SQL)
def op4_url_filter(spark, sf):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return urls.judge_urls(table(spark, sf, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


@query("op5_byte_bpe")
def op5_byte_bpe(spark, sf):
    return bytepairs.coding_digest(table(spark, sf, "documents"), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


JOIN_SQL = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(list_slice(ws, i, i + 3), ' '))) END AS sh FROM w),
g AS (SELECT rid, doc_id, len(sh) AS n, unnest(sh) AS t FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y FROM g a JOIN g b ON a.t = b.t AND a.rid <> b.rid GROUP BY a.rid, b.rid, a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS x, doc_id AS y FROM s UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id FROM s JOIN c ON doc_id = x
"""


@query("op6_ngram_join", JOIN_SQL)
def op6_ngram_join(spark, sf):
    return ngramjoin.link_documents(table(spark, sf, "documents"), size=4, percent=85).drop("digest", "class_label")


def _sql_scores() -> str:
    return """1 AS one, 100 * word_chars // greatest(n_words, 1) AS m1, 1000 * n_symbols // greatest(n_words, 1) AS m2,
  1000 * n_dup_lines // greatest(n_lines, 1) AS m3, 1000 * n_repeat_words // greatest(n_words, 1) AS m4"""


def _sql_fence() -> str:
    """The fences of each language, source and metric, as the operator draws them."""
    least = " ".join(f"WHEN {i} THEN {w}" for i, (w, _) in enumerate(quality.METRICS.values(), 1))
    p = quality.PRECISION
    return f"""
long AS (SELECT lang, source, unnest([1, 2, 3, 4]) AS m, unnest([m1, m2, m3, m4]) AS v FROM s WHERE NOT base_failed),
bins AS (SELECT lang, source, m, v // step * step AS b, count(*) AS n
  FROM (SELECT *, CAST(pow(2, greatest(length(bin(v)) - {p}, 0)) AS BIGINT) AS step FROM long) GROUP BY ALL),
run AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, m ORDER BY b) AS c, sum(n) OVER (PARTITION BY lang, source, m) AS a FROM bins),
q AS (SELECT lang, source, m, min(b) FILTER (100 * c >= 25 * a) AS q1, min(b) FILTER (100 * c >= 75 * a) AS q3 FROM run GROUP BY ALL),
f AS (SELECT *, {quality.FENCE} * greatest(q3 - q1, CASE m {least} END) AS width FROM q),
fence AS (SELECT lang, source, """ + ", ".join(
        f"max(q1 - width) FILTER (m = {i}) AS low{i}, max(q3 + width) FILTER (m = {i}) AS high{i}" for i in range(1, 5)
    ) + " FROM f GROUP BY ALL)"


def _sql_inside() -> str:
    return " AND ".join(
        f"m{i} <= high{i}" + (f" AND m{i} >= low{i}" if low else "") for i, (_, low) in enumerate(quality.METRICS.values(), 1)
    )


MEASURES_SQL = r"""
t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text,
  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
w AS (SELECT doc_id, pos, unnest(list_transform(range(1, len(words) - 6), lambda i: array_to_string(list_slice(words, i, i + 7), ' '))) AS win,
  unnest(range(1, len(words) - 6)) AS spot FROM (SELECT doc_id, words, 0 AS pos FROM t WHERE len(words) >= 8)),
r AS (SELECT doc_id, spot FROM w QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
rep AS (SELECT doc_id, count(DISTINCT spot + d) AS n_repeat_words FROM r, (SELECT unnest(range(0, 8)) AS d) GROUP BY doc_id),
b AS (SELECT t.doc_id, lang, source, text, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
  len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM t LEFT JOIN rep ON t.doc_id = rep.doc_id),
s AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, """ + _sql_scores() + " FROM b)"

QUALITY_SQL = f"""
WITH {MEASURES_SQL}, {_sql_fence()}
SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce({_sql_inside()}, false) AS kept
FROM s LEFT JOIN fence ON s.lang IS NOT DISTINCT FROM fence.lang AND s.source IS NOT DISTINCT FROM fence.source
"""


@query("op7_quality_rules", QUALITY_SQL)
def op7_quality_rules(spark, sf):
    judged = quality.quality_table(table(spark, sf, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


NEAREST_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""


@query("op8_exact_top_k", NEAREST_SQL)
def op8_exact_top_k(spark, sf):
    return nearest.top_k(table(spark, sf, "embeddings"), k=5, every=50)


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"), public_tokenizers.path(WORD_FILE), SEQUENCE, END_ID)


def _sql_escape(text: str) -> str:
    text = f"replace({text}, '%', '%25')"
    for c in sorted(chat.CONTROLS, key=len, reverse=True):
        text = f"replace({text}, '{c}', '%{ord(c[0]):02X}{c[1:]}')"
    return text


CHAT_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
m AS (SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS begins,
  length({_sql_escape("text")}) AS n, length(replace({_sql_escape("role")}, chr(10), '%0A')) AS r FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + CASE WHEN begins THEN r + {len(chat.START) + 1 + len(chat.END)} ELSE {len(chat.BREAK)} END) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""


@query("op10_chat_format", CHAT_SQL)
def op10_chat_format(spark, sf):
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.chat_digest(chat.format_chats(turns))


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: from some word on, every tenth text (by crc32 of its id) repeats a stretch of its words."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.expr("filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')"))
    out = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("ws")).withColumn("n", F.size("ws"))
    out = out.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    out = out.withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)"))
    again = F.expr("array_join(slice(concat(slice(ws, 1, a), flatten(array_repeat(slice(ws, a + 1, p), CAST(ceil((n - a) / p) AS INT)))), 1, n), ' ')")
    return out.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark, sf):
    return periodic.run_digest(periodic.collapse_runs(planted(table(spark, sf, "documents"))))


SEARCH_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
t AS (SELECT rid, doc_id, translate(unnest(ts), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
n AS (SELECT rid, doc_id, count(*) AS n FROM t GROUP BY rid, doc_id),
s AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS l FROM n),
f AS (SELECT rid, term, count(*) AS tf FROM t GROUP BY rid, term),
g AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term),
i AS (SELECT DISTINCT item_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM benchmark),
r AS (SELECT item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // l)))) AS BIGINT) AS score
  FROM i JOIN g USING (term) JOIN f USING (term) JOIN n USING (rid), s GROUP BY item_id, rid, doc_id)
SELECT item_id, CAST(row_number() OVER o AS INTEGER) AS rank, doc_id, score FROM r WHERE score > 0
WINDOW o AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER o <= 50
"""


@query("op13_ranked_search", SEARCH_SQL)
def op13_ranked_search(spark, sf):
    return lexical.ranked_search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=50)


@query("op12_html_extraction")
def op12_html_extraction(spark, sf):
    pages = table(spark, sf, "pages")
    return extract.extract_text(pages, extract.fit_extractor(pages))
