"""One query per operator of this subpackage, over its whole table, with a DuckDB twin where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoloom.llm import (
    chat, collocations, jaccard_join, language, licenses, mixing, order_minhash, pieces, quality, secrets, topk, toxicity, trie,
)

QUERIES = {}
ORACLES = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


@query("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents"), pieces.read_model())


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(_table(spark, sf_dir, "documents"))


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"), licenses.templates(spark))


@query("op4_order_minhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(_table(spark, sf_dir, "documents"))


@query(
    "op5_ngram_jaccard_join",
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
               ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words
    ), grams AS (SELECT doc_id, unnest(s) AS g FROM sets
    ), links AS (
        SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
        JOIN sets x ON x.doc_id = a.doc_id JOIN sets y ON y.doc_id = b.doc_id
        GROUP BY a.doc_id, b.doc_id, len(x.s), len(y.s) HAVING 100 * count(*) >= 90 * (len(x.s) + len(y.s) - count(*))
    ), reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.b) AS component_id
    FROM sets s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, len(s.s)
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), k=3, num=9, den=10)


@query(
    "op6_chat_format",
    r"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    ), sized AS (
        SELECT *, length(text) + len(text) - len(replace(replace(replace(text, '\', ''), '#', ''), '<', '')) AS body,
               length(role) + len(role) - len(replace(replace(replace(replace(role, '\', ''), '#', ''), '<', ''), ':', '')) AS head FROM rows
    )
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(4 + head + 2 + body + 8) AS BIGINT) AS formatted_chars
    FROM sized GROUP BY conv_id
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "\\### Assistant: </turn> ok"
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], rows.schema)
    out = chat.read_back(chat.format_branches(chat.threads(rows.union(extra))))
    return out.select(F.col("tree").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


@query(
    "op7_exact_top_k",
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op8_source_mixing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(_table(spark, sf_dir, "documents"), max_repetition=2.0)


@query("op9_secret_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query(
    "op11_quality_rules",
    r"""
    WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents
    ), cut AS (
        SELECT doc_id, lang, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
               list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t
    ), windows AS (
        SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM cut)
    ), twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1
    ), repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id
    ), m AS (
        SELECT cut.doc_id, len(w) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
               length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(ls) AS n_lines,
               len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter_words,
               length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_capitals,
               len(list_filter(w, lambda x: lower(translate(x, '.,;:!?"''()', '')) IN (
                   'the','of','and','to','a','in','is','that','for','it','was','on','with','be','as','by','this','are','at','from','or','an','have','not','he',
                   'de','la','le','et','les','des','en','un','du','une','que','pour','est','qui','dans','par','pas','au','sur','avec','ce','il','se','ne','plus',
                   'der','die','und','den','von','zu','das','sich','mit','auf','für','ist','nicht','im','dem','ein','eine','als','auch','es','er',
                   'el','y','los','del','las','por','no','con','su','una','para','al','lo','como','más','o','pero','sus'))) AS n_stop_words,
               CASE WHEN coalesce(lang IN ('en', 'fr', 'de', 'es'), true) THEN len(w) ELSE 0 END AS n_stop_base,
               len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_cut_lines,
               len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullets
        FROM cut LEFT JOIN repeats r ON r.doc_id = cut.doc_id
    ), judged AS (
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, array_to_string(list_filter([
            CASE WHEN n_words > 0 AND (100 * word_chars < 250 * n_words OR 100 * word_chars > 1500 * n_words) THEN 'word_length' END,
            CASE WHEN n_words > 0 AND 100 * n_symbols > 10 * n_words THEN 'symbols' END,
            CASE WHEN n_words > 0 AND 100 * n_letter_words < 70 * n_words THEN 'letters' END,
            CASE WHEN word_chars > 0 AND 100 * n_capitals > 50 * word_chars THEN 'capitals' END,
            CASE WHEN n_stop_base > 0 AND 100 * n_stop_words < 2 * n_stop_base THEN 'stop_words' END,
            CASE WHEN n_lines > 0 AND 100 * n_dup_lines > 30 * n_lines THEN 'duplicate_lines' END,
            CASE WHEN n_lines > 0 AND 100 * n_cut_lines > 30 * n_lines THEN 'cut_lines' END,
            CASE WHEN n_lines > 0 AND 100 * n_bullets > 90 * n_lines THEN 'bullets' END], lambda x: x IS NOT NULL), ',') AS broken FROM m
    )
    SELECT *, NOT base_failed AND broken = '' AS kept FROM judged
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(_table(spark, sf_dir, "documents"))


@query(
    "op12_phrase_collocations",
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents
    ), words AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
    ), grams AS (
        SELECT lang, 1 AS k, unnest(w) AS g FROM words
        UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
        UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words
    ), f AS (SELECT lang, k, g, CAST(count(*) AS BIGINT) AS f FROM grams GROUP BY lang, k, g
    ), n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
    ), cand AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS w FROM f WHERE k > 1 AND f >= 10
    ), cuts AS (
        SELECT lang, k, g, a, c, array_to_string(w[1:c], ' ') AS first, array_to_string(w[c + 1:], ' ') AS rest
        FROM (SELECT *, unnest(range(1, k)) AS c FROM cand)
    ), scored AS (
        SELECT c.*, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
        FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.first JOIN f y ON y.lang = c.lang AND y.g = c.rest
    ), least AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, c) AS place FROM scored) WHERE place = 1
    ), inside AS (
        SELECT lang, g, max(a) AS cover FROM (
            SELECT lang, a, w[1] || ' ' || w[2] AS g FROM cand WHERE k = 3 UNION ALL SELECT lang, a, w[2] || ' ' || w[3] FROM cand WHERE k = 3)
        GROUP BY lang, g
    ), kept AS (
        SELECT s.lang, s.g, s.a, s.l, s.r, s.score, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.g) AS rank
        FROM least s LEFT JOIN inside i ON i.lang = s.lang AND i.g = s.g AND s.k = 2 WHERE i.cover IS NULL OR 100 * i.cover < 50 * s.a
    )
    SELECT kept.lang, rank, g AS phrase, a, l, r, n, score FROM kept JOIN n ON n.lang = kept.lang WHERE rank <= 2000
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"))


@query(
    "op13_conversation_trie",
    r"""
    WITH RECURSIVE raw AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
    ), turns AS (
        SELECT conv_id, length(role) || ':' || role || text AS key, len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS tokens,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) - 1 AS pos FROM raw
    ), tab AS (
        SELECT CAST(range AS UBIGINT) AS i, 0 AS k, CAST(range AS UBIGINT) AS c FROM range(256)
        UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM tab WHERE k < 8
    ), crc AS (
        SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS p, 4294967295::UBIGINT AS c FROM turns
        UNION ALL SELECT crc.conv_id, s, p + 1, xor(crc.c >> 8, t.c) FROM crc
        JOIN tab t ON t.k = 8 AND t.i = xor(crc.c, CAST(ascii(s[p + 1]) AS UBIGINT)) & 255 WHERE p < length(s)
    ), convs AS (
        SELECT conv_id, CAST(xor(c, 4294967295::UBIGINT) % 4 AS BIGINT) AS h, conv_id - conv_id % 20 AS leader FROM crc WHERE p = length(s)
    ), rebuilt AS (
        SELECT c.conv_id, t.pos, t.key, t.tokens FROM convs c JOIN turns t ON t.conv_id = c.leader AND t.pos < c.h
        UNION ALL SELECT c.conv_id, t.pos, t.key, t.tokens FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h
    ), steps AS (
        SELECT conv_id, row_number() OVER w AS depth, list(key) OVER w AS path, tokens FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
        UNION ALL SELECT conv_id, 0, [], 0 FROM convs
    ), nodes AS (
        SELECT path, min(conv_id) AS conv_id, max(depth) AS depth, count(*) AS n_convs, max(tokens) AS tokens FROM steps GROUP BY path
    ), kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY path[1:depth - 1]
    ), below AS (
        SELECT s.path, count(*) FILTER (k.n IS NULL) AS n_leaves, CAST(sum((y.n_convs - 1) * y.tokens) AS BIGINT) AS saved_tokens
        FROM nodes y JOIN steps s ON s.conv_id = y.conv_id AND s.depth <= y.depth LEFT JOIN kids k ON k.path = y.path GROUP BY s.path
    ), ended AS (
        SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS hash FROM steps s
        WHERE depth = (SELECT max(z.depth) FROM steps z WHERE z.conv_id = s.conv_id) GROUP BY path
    )
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, b.n_leaves, b.saved_tokens,
           coalesce(e.hash, sha256('')) AS ends_sha256
    FROM nodes n JOIN below b ON b.path = n.path LEFT JOIN kids k ON k.path = n.path LEFT JOIN ended e ON e.path = n.path
    LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.shared_heads(trie.numbered(_table(spark, sf_dir, "conversations"))))
