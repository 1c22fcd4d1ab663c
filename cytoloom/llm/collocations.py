"""Phrase collocations from a weighted de Bruijn graph of the texts.

Words are A-Z lower-cased runs of other characters than space and tab, inside pieces cut at ``. , ; : ! ?`` and
line ends. The edges of the graph are the phrases of ``max_words`` words with their number of
occurrences per language; an edge leads from the node of its first ``max_words - 1`` words to the node of
its last ones. Nothing shorter is ever counted: what flows out of a node along its edges, plus the pieces
that end in it, is the count of the node's phrase, and the counts of still shorter phrases follow
from the flows of the nodes that start with them, again with a correction for piece ends. Flows
are sums, so they are taken per block of text and added up in the same shuffle that adds up the
edges, in which a row holds many nodes with their out-edges.

Edges that reach the least count make up a much smaller graph. Its unary paths are compacted by pointer
doubling: an inner node of a path has one edge in and one out, so its longer phrases are
read off the path, and only junctions meet all their edges in a grouping.

Defined results: a null text has no words, a null language is ``und``; repeated rows count
again; other columns, ids included, are not read. Arithmetic is exact while counts stay below 10^16.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoloom.llm.text import blocks, mix
from cytoloom.session import stored

PIECE_ENDS = r"[.,;:!?\x0A-\x0D]+"
# Parts of a language that choose their best phrases apart before the language does.
SALTS = 32
SCALE = 1_000_000
# Bytes of text whose edges are made in one step; a step holds some fifty times as much.
STEP_BYTES = 2 << 20
# Buckets per shuffle partition. A bucket's phrases of one step travel as one row, sorted, which spells
# their common starts once when the shuffle is compressed.
BUCKETS_PER_PARTITION = 2

BLANK = pa.scalar(" ", pa.large_string())
BREAK = [pa.scalar("\n", pa.large_string()), BLANK]
PHRASES = "lang string, bucket int, phrases string, counts array<int>"


def _tokens(block: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Vocabulary, word number and language number per token, words left in its piece, languages.

    A piece end is a token that is no word; it has 0 words left.
    """
    # rows are copied out: ascii_lower of pyarrow 23 reads a cast slice from its start
    text = pc.fill_null(block.column("text"), "").take(pa.array(np.arange(block.num_rows))).cast(pa.large_string())
    text = pc.replace_substring_regex(pc.ascii_lower(text), PIECE_ENDS, " \n ")
    text = pc.replace_substring(pc.binary_join_element_wise(text, *BREAK), "\t", " ")
    parts = pc.split_pattern(text, " ")
    words, rows = pc.list_flatten(parts), pc.list_parent_indices(parts)
    full = pc.not_equal(words, "")
    coded = words.filter(full).dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    langs = pc.fill_null(block.column("lang"), "und").dictionary_encode()
    of_row = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lang = of_row[rows.filter(full).to_numpy(zero_copy_only=False)]
    end = pc.index(coded.dictionary, pa.scalar("\n", pa.large_string())).as_py()
    ends = np.flatnonzero(ids == end)
    left = ends[np.searchsorted(ends, np.arange(len(ids)))] - np.arange(len(ids))
    return coded.dictionary, ids, lang, left, langs.dictionary


def _phrase_rows(block: pa.RecordBatch, n: int, buckets: int) -> pa.RecordBatch:
    """The edges of a block and the flow of every shorter phrase, packed by language and bucket: lines of text and their counts.

    A bucket holds whole nodes: a phrase of ``n`` words goes with its first ``n - 1``.
    """
    vocabulary, ids, lang, left, langs = _tokens(block)
    # codes in the order of the words, so that phrases with the same start lie next to each other
    order = pc.sort_indices(vocabulary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    vocabulary, ids = vocabulary.take(pa.array(order)), rank[ids]
    hashes = pd.util.hash_array(vocabulary.to_numpy(zero_copy_only=False)).astype(np.uint64)
    v = len(vocabulary)
    at = np.flatnonzero(left > 0)
    levels = []  # per length: the phrase of one word less, the last word, and how many pieces end there
    codes = lang[at]
    for k in range(1, n):
        keys, codes = np.unique(codes * v + ids[at + k - 1], return_inverse=True)
        ending = left[at] == k
        levels.append((keys // v, keys % v, np.bincount(codes[ending], minlength=len(keys))))
        at, codes = at[~ending], codes[~ending]
    edges, weight = np.unique(codes * v + ids[at + n - 1], return_counts=True)
    flows = [np.bincount(edges // v, weight, len(levels[-1][0])).astype(np.int64) + levels[-1][2]]
    for k in range(n - 2, 0, -1):
        into = np.bincount(levels[k][0], flows[0], len(levels[k - 1][0])).astype(np.int64)
        flows.insert(0, into + levels[k - 1][2])
    # the empty phrase: all words of a language
    found = [(np.arange(len(langs)), np.zeros(len(langs), np.int64), pa.array([""] * len(langs), pa.large_string()),
              np.bincount(levels[0][0], flows[0], len(langs)).astype(np.int64))]
    of_lang, bucket, phrases = np.arange(len(langs)), np.zeros(len(langs), np.uint64), None
    for k, (prefix, last) in enumerate([*[x[:2] for x in levels], (edges // v, edges % v)], start=1):
        words = vocabulary.take(pa.array(last))
        phrases = words if phrases is None else pc.binary_join_element_wise(phrases.take(pa.array(prefix)), words, BLANK)
        of_lang = of_lang[prefix]
        bucket = mix(bucket[prefix] + hashes[last]) if k < n else bucket[prefix]
        found.append((of_lang, (bucket % np.uint64(buckets)).astype(np.int64), phrases, flows[k - 1] if k < n else weight))
    place = np.concatenate([x[0] * buckets + x[1] for x in found])
    sort = np.argsort(place, kind="stable")
    starts = np.flatnonzero(np.diff(place[sort], prepend=-1))
    offsets = pa.array(np.append(starts, len(sort)).astype(np.int32))
    text = pa.concat_arrays([x[2].cast(pa.string()) for x in found]).take(pa.array(sort))
    counts = np.concatenate([x[3] for x in found])[sort].astype(np.int32)
    head = place[sort][starts]
    return pa.RecordBatch.from_arrays(
        [langs.take(pa.array(head // buckets)).cast(pa.string()), pa.array((head % buckets).astype(np.int32)),
         pc.binary_join(pa.ListArray.from_arrays(offsets, text), "\n"), pa.ListArray.from_arrays(offsets, pa.array(counts))],
        ["lang", "bucket", "phrases", "counts"],
    )


def phrase_counts(docs: DataFrame, max_words: int, min_count: int) -> DataFrame:
    """(lang, phrase, k, n): phrases of 1 to ``max_words`` words that come ``min_count`` times or more.

    The phrase without words (k = 0) holds the number of all words of its language. The table is stored.
    """
    buckets = BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, size=STEP_BYTES):
                if not pc.all(pc.equal(pc.fill_null(pc.binary_length(block.column("text")), 0), 0)).as_py():
                    yield _phrase_rows(block, max_words, buckets)

    # one shuffle of packed rows; sums are taken inside a bucket
    rows = docs.select("text", "lang").mapInArrow(phrases, PHRASES).repartition("lang", "bucket")
    each = rows.select("lang", "bucket", F.explode(F.arrays_zip(F.split("phrases", "\n", -1).alias("phrase"), F.col("counts").alias("n"))).alias("e"))
    summed = each.groupBy("lang", "bucket", "e.phrase").agg(F.sum("e.n").alias("n")).where((F.col("n") >= min_count) | (F.col("phrase") == ""))
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return stored(summed.select("lang", "phrase", words.alias("k"), "n"), "phrases")


def _without(phrase: str, last: bool) -> Column:
    """The phrase without its last or first word."""
    return F.regexp_replace(phrase, " [^ ]*\\z", "") if last else F.regexp_replace(phrase, "\\A[^ ]* ", "")


def compact(edges: DataFrame) -> DataFrame:
    """(lang, path, pos, phrase, n, from, to): every edge of ``edges(lang, phrase, n)`` with its unary path.

    A path runs on through nodes that have one edge in and one out. It is named by its first
    edge, found by pointer doubling: a round halves the way to it, and is stored. Edges on a
    ring without a junction, which has no first edge, are paths of their own.
    """
    e = stored(edges.select("lang", "phrase", "n", _without("phrase", True).alias("from"), _without("phrase", False).alias("to")), "edges")
    ins = e.groupBy("lang", F.col("to").alias("from")).agg(F.count(F.lit(1)).alias("ins"), F.min("phrase").alias("before"))
    outs = e.groupBy("lang", "from").agg(F.count(F.lit(1)).alias("outs"), F.min("phrase").alias("edge"))
    inner = ins.join(outs, ["lang", "from"]).where("ins = 1 AND outs = 1 AND before <> edge").select("lang", F.col("edge").alias("phrase"), "before")
    state = e.select("lang", "phrase").join(inner, ["lang", "phrase"], "left").select(
        "lang", "phrase", F.coalesce("before", "phrase").alias("path"), F.col("before").isNotNull().cast("long").alias("pos"),
        F.col("before").isNull().alias("done"))
    before = None
    while True:
        state = stored(state, "paths")
        undone = state.where("NOT done").count()
        if undone in (0, before):  # a round that brings nobody home: only rings are left
            break
        before = undone
        there = state.select("lang", F.col("phrase").alias("path"), F.col("path").alias("further"), F.col("pos").alias("more"), F.col("done").alias("last"))
        moved = state.where("NOT done").join(there, ["lang", "path"]).select(
            "lang", "phrase", F.col("further").alias("path"), (F.col("pos") + F.col("more")).alias("pos"), F.col("last").alias("done"))
        state = state.where("done").unionByName(moved)
    alone = state.select("lang", "phrase", F.expr("if(done, path, phrase)").alias("path"), F.expr("if(done, pos, 0)").alias("pos"))
    return alone.join(e, ["lang", "phrase"])


def passages(docs: DataFrame, max_words: int = 3, min_count: int = 10) -> DataFrame:
    """(lang, phrase, n_words, n): the unary paths spelled out, with the count of their rarest edge."""
    paths = compact(phrase_counts(docs, max_words, min_count).where(F.col("k") == max_words).drop("k"))
    last = F.substring_index("phrase", " ", -1)
    steps = F.array_sort(F.collect_list(F.struct("pos", last.alias("word"))))
    spelled = paths.groupBy("lang", "path").agg(steps.alias("steps"), F.min("n").alias("n"))
    tail = F.transform(F.slice("steps", 2, F.greatest(F.size("steps") - 1, F.lit(0))), lambda s: s["word"])
    phrase = F.concat_ws(" ", F.col("path"), tail)
    return spelled.select("lang", phrase.alias("phrase"), (F.size("steps") + max_words - 1).alias("n_words"), "n")


def _node_cover(paths: DataFrame) -> DataFrame:
    """(lang, phrase, cover): the largest count of an edge into or out of a node."""
    along = Window.partitionBy("lang", "path").orderBy("pos")
    walk = paths.select("*", F.lead("n").over(along).alias("next"), F.col("pos").alias("at"))
    inside = walk.where("next IS NOT NULL").select("lang", F.col("to").alias("phrase"), F.greatest("n", "next").alias("cover"))
    ends = walk.where("next IS NULL").select("lang", F.col("to").alias("phrase"), F.col("n").alias("cover")).union(
        walk.where("pos = 0").select("lang", F.col("from").alias("phrase"), F.col("n").alias("cover")))
    return inside.union(ends.groupBy("lang", "phrase").agg(F.max("cover").alias("cover")))


def _cover(counts: DataFrame, max_words: int) -> DataFrame:
    """(lang, phrase, cover): the largest count of a candidate that holds the phrase and one word more.

    No longer one comes more often, and every phrase on the way to it is a candidate too.
    """
    cover = _node_cover(compact(counts.where(F.col("k") == max_words).drop("k")))
    if max_words > 3:
        longer = counts.where(F.col("k").between(3, max_words - 1))
        both = longer.select("lang", _without("phrase", True).alias("phrase"), "n").union(
            longer.select("lang", _without("phrase", False).alias("phrase"), "n"))
        cover = cover.union(both.groupBy("lang", "phrase").agg(F.max("n").alias("cover")))
    return cover


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(18,0)")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score): candidates of two words and more with their lowest-scoring cut."""
    candidates = counts.where("k >= 2").withColumnRenamed("n", "a")
    cuts = candidates.select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.selectExpr("*", "substring_index(phrase, ' ', cut) AS first", "substring_index(phrase, ' ', cut - k) AS rest")
    part = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    sized = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    square = (_exact("a") * _exact("a")).cast("decimal(38,0)") * F.lit(SCALE).cast("decimal(7,0)")
    sized = sized.select("*", square.cast("decimal(38,0)").alias("__square"), (_exact("l") * _exact("r")).cast("decimal(38,0)").alias("__whole"))
    sized = sized.select("*", F.expr("__square div __whole").alias("score"))
    least = F.min(F.struct("score", "cut", "l", "r")).alias("least")
    return sized.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "least.l", "least.r", "least.score")


def mine(docs: DataFrame, max_words: int = 3, min_count: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    A phrase that lies in a longer candidate is dropped when that one has ``share`` percent of
    its occurrences. ``top`` is the length of a language's report; ties go to the
    more frequent, then to the smaller phrase in UTF-8 byte order.
    """
    counts = phrase_counts(docs, max_words, min_count)
    phrases = counts.where("k > 0")
    found = scored(phrases).join(_cover(phrases, max_words), ["lang", "phrase"], "left")
    found = found.where(F.coalesce(100 * F.col("cover") < share * F.col("a"), F.lit(True)))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salted = found.withColumn("__salt", F.pmod(F.hash("phrase"), F.lit(SALTS)))
    place = F.row_number().over(Window.partitionBy("lang", "__salt").orderBy(*order))
    parts = stored(salted.withColumn("__place", place).where(F.col("__place") <= top), "parts")
    # when all parts have this many phrases, the worst of these scores is reached by ``top`` phrases at least
    enough = -(-top // SALTS)
    floor = parts.where(F.col("__place") == enough).groupBy("lang").agg(F.min("score").alias("__floor"), F.count(F.lit(1)).alias("__parts"))
    near = parts.join(floor.where(F.col("__parts") == SALTS).select("lang", "__floor"), "lang", "left")
    near = near.where("__floor IS NULL OR score >= __floor")
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    words = counts.where("k = 0").select("lang", "n")
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
