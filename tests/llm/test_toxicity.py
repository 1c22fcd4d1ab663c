"""Held-out quality, misspellings, odd rows."""

import random
import tracemalloc
import zlib

import numpy as np

from cytoloom.llm import toxicity
from tests.llm.cases import empty_docs, odd_docs

BAD = ["scoundrel", "blockhead", "nitwit", "rascal"]


def test_held_out_and_misspelled(spark):
    rng = random.Random(2)
    good = ["".join(rng.choice("aeioutrnsl") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    docs, labels = [], []
    for i in range(900):
        words = [rng.choice(good) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(40)] = rng.choice(BAD)
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    # never seen: misspelled, without a label
    docs += [(1000 + j, " ".join([rng.choice(good) for _ in range(36)] + ["scoundrell", "blokhead", "nitwitt", "rascall"])) for j in range(20)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    out = {r.doc_id: r for r in toxicity.score(d, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(out[i].held_out == (i in held) for i in range(900))
    assert sum(out[i].predicted == labels[i][1] for i in held) >= 0.97 * len(held)
    assert sum(out[1000 + j].predicted for j in range(20)) >= 17


def test_labels_of_held_out_rows_do_not_count(spark):
    docs = spark.createDataFrame([(i, f"text {i % 5} word{i % 3}") for i in range(60)], "doc_id long, text string")
    one = [(i, i % 2) for i in range(60)]
    two = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in one]
    a, b = (sorted(map(tuple, toxicity.score(docs, spark.createDataFrame(x, "doc_id long, toxic int")).collect())) for x in (one, two))
    assert a == b


def test_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(0, 1), (40, 0), (60, 1), (60, 0), (None, 1), (70, None), (80, 0)], "doc_id long, toxic int")
    out = toxicity.score(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(empty_docs(spark), labels).count() == 0
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r.predicted == 0 for r in toxicity.score(docs, nothing).collect())
    assert toxicity.drop_toxic(docs, nothing).count() == docs.count()
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns


def test_bags_of_the_sample_stay_out_of_memory(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("aeioutrnsl") for _ in range(9)) for _ in range(600)) for _ in range(400)]
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    tracemalloc.start()
    with toxicity.Bags() as bags:
        for text in texts:
            bags.add(text)
        toxicity.fit(bags, np.arange(400) % 2 > 0)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert bags.ends[-1] > 40e6 and peak < 30e6
        assert all((a == b).all() for i in (0, 399) for a, b in zip(bags[i], toxicity.bag(texts[i])))
