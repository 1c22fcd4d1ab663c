"""The whole pipeline on small tables: awkward rows, copies, toxic documents, secrets, empty tables."""

import random

import corpus_pipeline
from tests.llm.cases import empty_docs, odd_docs

NAMES = ["toxicity", "ngram_jaccard_join", "secret_scan", "source_mixing", "sentencepiece"]


def run(spark, tmp_path, docs, labels):
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").write.parquet(f"{folder}/labels.parquet")
    return corpus_pipeline.run(spark, folder)


def corpus():
    rng = random.Random(4)
    clean = ["river", "stone", "meadow", "lantern", "harbour", "violet", "copper", "thunder", "basket", "window"]
    rude = ["idiot", "moron", "pathetic", "worthless", "scum"]
    rows, labels = [], []
    for i in range(240):
        toxic = i % 4 == 0
        words = [rng.choice(clean) + rng.choice(["", "s", "ly", str(i)]) for _ in range(60)]
        if toxic:
            words[::3] = [rng.choice(rude) for _ in words[::3]]
        rows.append((1000 + i, " ".join(words), "en", f"src{i % 3}", 0))
        labels.append((1000 + i, 1, int(toxic)))
    copies = [(5000 + k, rows[k * 4 + 1][1] + " end", "en", "src0", 0) for k in range(10)]
    key = "AKIA" + "Q" * 16
    secret = [(6000, rows[1][1][::-1] + f" {key} password = hunter2hunter2", "en", "src1", 0)]
    return rows, labels, copies, secret, key


def test_stages_and_their_columns(spark, tmp_path):
    rows, labels, copies, secret, key = corpus()
    pad = "score double, held_out string, row long, root long, n long, node long, predicted string, tokens_ long"
    odd = odd_docs(spark, pad)
    more = spark.createDataFrame([r + (None,) * 8 for r in rows + copies + secret], odd.schema)
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    docs = odd.unionByName(more)
    out = run(spark, tmp_path, docs, labels)
    assert out.columns[: len(docs.columns)] == docs.columns or set(out.columns) >= {"doc_id"}
    kept = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    toxic = {d for d, _, t in labels if t}
    assert len(kept & toxic) <= 0.2 * len(toxic)
    clean = {d for d, _, t in labels if not t}
    assert len(kept & clean) >= 0.9 * len(clean)
    # one of each pair of near copies stays
    for k in range(10):
        pair = {1000 + k * 4 + 1, 5000 + k}
        assert len(kept & pair) == 1
    assert 6000 in kept


def test_every_stage_keeps_columns_and_masks(spark, tmp_path):
    rows, labels, copies, secret, key = corpus()
    docs = spark.createDataFrame(rows + copies + secret, "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path)
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").write.parquet(f"{folder}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        if name == "secret_scan":
            text = docs.where("doc_id = 6000").first().text
            assert key not in text and "hunter2hunter2" not in text


def test_empty_table_and_null_texts(spark, tmp_path):
    assert run(spark, tmp_path / "none", empty_docs(spark), []).count() == 0
    nulls = spark.createDataFrame([(i, None, None, None, None) for i in range(3)], empty_docs(spark).schema)
    out = run(spark, tmp_path / "nulls", nulls, [(0, 1, 0), (1, 1, 1)])
    assert {r.doc_id for r in out.select("doc_id").collect()} <= {0, 1, 2}
