"""Weights, budgets and permutations of a source mix."""

import math

from pyspark.sql import functions as F

from cytoloom.llm import mixing
from tests.llm.cases import empty_docs, odd_docs

SIZES = {"big": 3000, "mid": 900, "small": 300}


def docs_of(spark):
    rows = [(f"{s}{i}", s, " ".join(["w"] * (1 + i % 7))) for s, n in SIZES.items() for i in range(n)]
    return spark.createDataFrame([(k, t, s) for k, (_, s, t) in enumerate(rows)], "doc_id long, text string, source string")


def tokens_of(df):
    return {r.source: r.n for r in df.groupBy("source").agg(F.sum("tokens").alias("n")).collect()}


def test_repetition_limit(spark):
    docs = docs_of(spark)
    out = mixing.schedule(docs, max_repetition=2.0, block_tokens=500).cache()
    natural = {s: sum(1 + i % 7 for i in range(n)) for s, n in SIZES.items()}
    used = tokens_of(out)
    repeats = {s: used[s] / natural[s] for s in natural}
    assert abs(repeats["big"] - 1) < 0.01 and abs(repeats["small"] - 2) < 0.02 and 1 < repeats["mid"] < 2
    # a document occurs once per epoch, and in every epoch before the last
    assert out.groupBy("doc_id", "epoch").count().where("count > 1").isEmpty()
    assert out.where("epoch = 0").select("doc_id").distinct().count() == docs.count()
    # every full block holds the sources in target weights
    weights = {s: n / sum(used.values()) for s, n in used.items()}
    blocks = out.groupBy("block").pivot("source").agg(F.sum("tokens")).orderBy("block").collect()
    for b in blocks[:-1]:
        assert all(abs(b[s] - 500 * w) <= 14 for s, w in weights.items())


def test_entropy_target(spark):
    _, plan = mixing.source_plan(docs_of(spark), entropy=0.9)
    w = [r.weight for r in plan.collect()]
    assert abs(sum(w) - 1) < 1e-9
    assert abs(-sum(x * math.log(x) for x in w) / math.log(3) - 0.9) < 1e-6


def test_stage_equals_schedule(spark):
    docs = docs_of(spark)
    rows = mixing.mix_sources(docs, max_repetition=2.0)
    assert rows.columns == docs.columns
    have = {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    want = {r.doc_id: r["count"] for r in mixing.schedule(docs, max_repetition=2.0).groupBy("doc_id").count().collect()}
    assert have == want
    budget = mixing.mix_sources(docs, max_repetition=2.0, budget=4000)
    total = budget.select(mixing.n_tokens(F.col("text")).alias("tokens")).agg(F.sum("tokens")).first()[0]
    assert 4000 - 3 <= total < 4000 + 3 * 7  # a source's budget is a whole number


def test_odd_rows(spark):
    docs = odd_docs(spark)
    out = mixing.schedule(docs, max_repetition=2.0)
    assert out.where("epoch = 0").count() == docs.count()
    rows = mixing.mix_sources(docs, max_repetition=2.0)
    assert rows.columns == docs.columns and rows.count() == out.count()
    assert mixing.schedule(empty_docs(spark)).count() == 0 and mixing.mix_sources(empty_docs(spark)).count() == 0
