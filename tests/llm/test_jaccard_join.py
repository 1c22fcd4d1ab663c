"""The n-gram Jaccard join against all pairs in plain Python."""

import random
import re
import tracemalloc
from itertools import combinations

import numpy as np

from cytoloom.llm import jaccard_join
from cytoloom.llm.jaccard_join import drop_near_copies, drop_near_copy_rows, jaccard_components
from cytoloom.session import stored
from tests.llm.cases import empty_docs, odd_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    if len(words) < k:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute_force(rows, k, num, den):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(
        ((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))),
        key=str,
    )


def same(spark, rows, k, num, den):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r) for r in jaccard_components(docs, k, num, den).collect()), key=str)
    assert found == brute_force(rows, k, num, den)


def test_chains_of_near_copies(spark):
    rng = random.Random(3)
    rows = []
    for family in range(6):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([4, 30, 90, 200]))]
        for _ in range(14):
            words = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                words[rng.randrange(len(words))] = f"w{rng.randrange(400)}"
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    same(spark, rows, 3, 9, 10)
    same(spark, rows, 5, 4, 5)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = sorted((tuple(r) for r in jaccard_components(docs, 3, 9, 10).collect()), key=str)
    assert found == brute_force(rows, 3, 9, 10)
    assert jaccard_components(empty_docs(spark), 3, 9, 10).count() == 0


def test_one_of_each_group_stays(spark):
    docs = odd_docs(spark)
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    kept = [i for i in ids if i is not None]
    assert len(kept) == len(set(kept)) and 60 in kept and 70 not in kept and 120 in kept and 130 not in kept
    assert ids.count(None) == 2
    assert drop_near_copies(empty_docs(spark)).count() == 0


def test_rows_are_judged_by_their_text(spark):
    text = lambda a: " ".join(f"{a}{i}" for i in range(40))
    rows = [
        (1, text("a")), (2, text("a")), (2, text("b")), (2, text("c")), (2, text("c") + " more"),
        (None, text("d")), (None, text("d") + " more"), (None, text("e")), (None, text("a")), (3, text("e")),
        (None, None), (None, ""), (4, None), (4, ""), (5, text("f")), (5, text("f")), (6, text("f")), (7, text("g")),
    ]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, root long")
    left = drop_near_copy_rows(docs)
    assert left.columns == docs.columns
    found = sorted(r.root for r in left.collect() if r.root not in (3, 4, 5, 6, 14, 15))
    # of 3 and 4, of 5 and 6, and of 14 and 15 one row stays
    assert found == [0, 2, 9, 10, 11, 12, 13, 17]
    assert left.count() == 11
    named = docs.where("root IN (0, 2, 7, 9, 16, 17)")
    assert sorted(r.root for r in drop_near_copy_rows(named.where("doc_id IS NOT NULL")).collect()) == [0, 2, 9, 16, 17]
    assert drop_near_copy_rows(empty_docs(spark)).count() == 0
    assert drop_near_copy_rows(odd_docs(spark)).columns == odd_docs(spark).columns
    assert drop_near_copy_rows(odd_docs(spark)).where("doc_id = 120").count() == 2


def test_unlike_words_of_a_thue_morse_pattern(spark):
    """Words of two letters in the Thue-Morse order and its mirror meet in any polynomial modulo a power of two."""
    word = "a"
    for _ in range(13):
        word += word.translate(str.maketrans("ab", "ba"))
    mirror = word.translate(str.maketrans("ab", "ba"))
    same(spark, [(1, word[:1024]), (2, mirror[:1024]), (3, word), (4, mirror), (5, word)], 3, 9, 10)


def test_a_passage_of_many_documents_makes_no_candidates(spark, monkeypatch):
    """Documents that share a passage, and nothing else, are told apart before pairs are written."""
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = []
    for d in range(400):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(25, 60))]
        words.insert(rng.randrange(len(words)), passage)
        rows.append((d, " ".join(words)))
    rows += [(1000 + d, t + " end") for d, t in rows[:20]]
    seen = []

    def counted(df, name="stored"):
        out = stored(df, name)
        if name == "candidates":
            seen.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "stored", counted)
    same(spark, rows, 5, 4, 5)
    assert sum(seen) < 200


def test_counting_needs_little_beside_the_shingles():
    shingles = np.random.default_rng(3).integers(0, 1 << 24, 1 << 20).astype(np.uint64)
    values, counts = np.unique(shingles, return_counts=True)
    jaccard_join._repeated(shingles[:9].copy())
    tracemalloc.start()
    found = jaccard_join._repeated(shingles)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found["doc_id"].to_numpy().tolist() == values[counts > 1].tolist()
    assert found["n"].to_numpy().tolist() == counts[counts > 1].tolist()
    assert peak < 1.5 * shingles.nbytes
    assert jaccard_join._repeated(shingles[:0]).num_rows == 0
