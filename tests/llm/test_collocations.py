"""Phrase counts, compaction and reports against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from cytoloom.llm import collocations
from cytoloom.llm.text import blocks
from tests.llm.cases import empty_docs, odd_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows, max_words):
    f, n = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang or "und", " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
    return f, n


def plain_report(rows, max_words, min_count, share, top):
    f, n = plain_counts(rows, max_words)
    size = lambda p: p.count(" ") + 1
    candidates = {k: a for k, a in f.items() if a >= min_count and size(k[1]) > 1}
    by_lang = defaultdict(list)
    for (lang, phrase), a in candidates.items():
        if any(o == lang and size(q) > size(phrase) and f" {phrase} " in f" {q} " and 100 * b >= share * a for (o, q), b in candidates.items()):
            continue
        w = phrase.split(" ")
        cuts = []
        for k in range(1, len(w)):
            left, right = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        by_lang[lang].append((-score, -a, phrase.encode(), a, left, right))
    return {
        (lang, i + 1, p.decode(), a, left, right, n[lang], -s)
        for lang, found in by_lang.items() for i, (s, _, p, a, left, right) in enumerate(sorted(found)[:top])
    }


def prose(seed=3, docs=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)] + ["the", "Of", "ÉCOLE", "école"]
    passage = " ".join(f"p{i}" for i in range(40))
    out = []
    for d in range(docs):
        words = [rng.choice(vocabulary) + rng.choice(["", "", "", ".", ", ", "\n"]) for _ in range(rng.randrange(60))]
        if d % 3 == 0:
            words.insert(rng.randrange(len(words) + 1), passage)
        if d % 4 == 0:
            words.append("a b c " * 5)  # a ring
        out.append((" ".join(words), rng.choice(["en", "de", None])))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string")


@pytest.mark.parametrize(("max_words", "min_count", "share", "top"), [(3, 3, 50, 2000), (4, 4, 80, 2000), (2, 3, 50, 7), (3, 2, 101, 12)])
def test_report_equals_plain_python(spark, max_words, min_count, share, top):
    rows = prose()
    out = collocations.mine(frame(spark, rows).repartition(3), max_words, min_count, share, top)
    have = {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in out.collect()}
    assert have == plain_report(rows, max_words, min_count, share, top)


@pytest.mark.parametrize("step", [1, 300, 5000])
def test_blocks_of_a_batch_add_up(step):
    rows = [(f"é{t}", lang) for t, lang in prose(11)] + [(None, "en"), ("", None)]
    batch = pa.RecordBatch.from_pylist([{"text": t, "lang": lang} for t, lang in rows]).slice(3)
    f, n = plain_counts(rows[3:], 3)
    have, places = Counter(), defaultdict(set)
    for block in blocks(batch, size=step):
        for r in collocations._phrase_rows(block, 3, 7).to_pylist():
            for phrase, count in zip(r["phrases"].split("\n"), r["counts"], strict=True):
                have[r["lang"], phrase] += count
                places[r["lang"], " ".join(phrase.split(" ")[:2])].add(r["bucket"])
    assert +have == f + Counter({(lang, ""): c for lang, c in n.items()})
    assert all(len(p) == 1 for p in places.values()) and len(set.union(*places.values())) == 7


def test_counts_come_from_flows(spark, monkeypatch):
    monkeypatch.setattr(collocations, "STEP_BYTES", 100)
    rows = prose(5)
    for max_words in (2, 3, 5):
        f, n = plain_counts(rows, max_words)
        have = {(r.lang, r.phrase): r.n for r in collocations.phrase_counts(frame(spark, rows), max_words, 1).collect()}
        assert have == dict(f) | {(lang, ""): c for lang, c in n.items()}


def test_paths_are_unary_and_whole(spark):
    counts = collocations.phrase_counts(frame(spark, prose(7)), 3, 3)
    edges = counts.where("k = 3").drop("k")
    paths = collocations.compact(edges).collect()
    assert sorted((r.lang, r.phrase, r.n) for r in paths) == sorted((r.lang, r.phrase, r.n) for r in edges.collect())
    ins, outs = defaultdict(set), defaultdict(set)
    for r in paths:
        outs[r.lang, r["from"]].add(r.phrase)
        ins[r.lang, r["to"]].add(r.phrase)
    place = {(r.lang, r.path, r.pos): r for r in paths}
    assert len(place) == len(paths)
    for (lang, path, pos), r in place.items():
        before = place.get((lang, path, pos - 1))
        assert (pos == 0) == (before is None)
        if before is not None:
            assert before["to"] == r["from"] and len(ins[lang, r["from"]]) == len(outs[lang, r["from"]]) == 1
    assert max(r.pos for r in paths) >= 37
    texts = {r.phrase for r in collocations.passages(frame(spark, prose(7)), 3, 3).collect()}
    assert any(" ".join(f"p{i}" for i in range(40)) in t for t in texts)


def test_a_ring_without_a_way_in(spark):
    edges = spark.createDataFrame([("en", p, 5) for p in ("a b c", "b c a", "c a b", "x x x")], "lang string, phrase string, n long")
    rows = {(r.phrase, r.path, r.pos) for r in collocations.compact(edges).collect()}
    assert rows == {(p, p, 0) for p in ("a b c", "b c a", "c a b", "x x x")}


def test_large_counts_are_exact(spark):
    a, left, right = 987_654_321_012, 1_234_567_890_123, 9_876_543_210_987
    counts = spark.createDataFrame([("en", "a b", 2, a), ("en", "a", 1, left), ("en", "b", 1, right)], "lang string, phrase string, k int, n long")
    assert collocations.scored(counts).first().score == 1_000_000 * a * a // (left * right)


def test_odd_rows_and_empty_tables(spark):
    docs = odd_docs(spark, "phrase string, n long, k int, total long")
    rows = [(r.text, r.lang) for r in docs.collect()]
    have = {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.mine(docs, 3, 2).collect()}
    assert have == plain_report(rows, 3, 2, 50, 2000)
    assert collocations.mine(empty_docs(spark)).count() == 0
    assert collocations.mine(frame(spark, [(None, "en"), ("", None), (" .\n", "de")])).count() == 0
