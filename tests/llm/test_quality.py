"""Quality measures against plain Python, and the rule table."""

import re
from collections import Counter

from cytoloom.llm import quality
from tests.llm.cases import empty_docs, odd_docs

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    t = text or ""
    words = WORD.findall(t)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    lines = [s for s in t.split("\n") if WORD.search(s)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def counts_of(rows):
    return Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)


def test_counts_equal_plain_python_on_odd_rows(spark):
    docs = odd_docs(spark)
    want = Counter((r.doc_id, *plain(r.text)) for r in docs.collect())
    assert counts_of(quality.scores(docs).collect()) == want


def test_repeated_windows(spark):
    base = " ".join(f"w{i}" for i in range(30))
    texts = [
        base, f"{base} {base}", "a " * 9, "a " * 8, f"x {base} y w3 w4 w5 w6 w7 w8 w9 w10 z", "a b " * 40 + base,
        " ".join(f"w{i}" for i in range(8)) + " sep " + " ".join(f"w{i}" for i in range(8)),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = quality.scores(docs).collect()
    assert counts_of(rows) == Counter((i, *plain(t)) for i, t in enumerate(texts))
    assert {r.doc_id for r in rows if r.base_failed} == {1, 2, 3, 4, 5, 6}


def test_rules(spark):
    prose = "the cat sat on the mat and it was of the opinion that this is for a day in the sun with nobody there to see"
    texts = {
        "": prose, "symbols": prose.replace(" ", " $ "), "capitals": prose.upper(), "stop_words": " ".join(f"xy{chr(97 + i)}" for i in range(25)),
        "word_length": " ".join("the " + "x" * 40 + chr(97 + i) for i in range(15)),
        "letters": prose + " " + " ".join(str(i) for i in range(30)),
        "duplicate_lines": "\n".join([prose] + [f"one of the {'x' * i}" for i in range(5)] + ["the line of it"] * 6),
        "cut_lines": "\n".join(f"the {'abcdefghij'[i] * 4} of {'klmnopqrst'[i] * 3} and..." for i in range(8)),
        "bullets": "\n".join(f" - the {'abcdefghij'[i] * 4} of {'klmnopqrst'[i] * 3} and" for i in range(8)),
    }
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts.values())], "doc_id long, text string")
    rows = {r.doc_id: r for r in quality.scores(docs).collect()}
    for i, name in enumerate(texts):
        assert rows[i].broken.split(",")[0] == name or name in rows[i].broken.split(","), (name, rows[i])
    assert rows[0].kept and not any(rows[i].kept for i in range(1, len(texts)))
    # another table, another verdict; a language without a list has no stop-word rule
    loose = quality.scores(docs, [quality.Rule("words", "n_words", "n_lines", low=100)])
    assert not any(r.broken for r in loose.collect())
    other = spark.createDataFrame([(1, texts["stop_words"], "pl"), (2, texts["stop_words"], None)], "doc_id long, text string, lang string")
    assert {r.doc_id: r.kept for r in quality.scores(other).collect()} == {1: True, 2: False}


def test_stage_keeps_columns_and_empty_tables(spark):
    docs = odd_docs(spark)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in quality.scores(docs).where("kept").collect())
    assert quality.scores(empty_docs(spark)).count() == 0 and quality.keep_good(empty_docs(spark)).count() == 0
    text = quality.scores(docs)._jdf.queryExecution().toString()
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text
