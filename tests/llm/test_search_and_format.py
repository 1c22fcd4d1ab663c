"""Top-k, chat formatting, fingerprints, licenses and languages against plain Python."""

import hashlib
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from cytoloom.llm import chat, language, licenses, order_minhash, topk
from tests.llm.cases import ODD_TEXTS, empty_docs, odd_docs


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 150)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 9)
    monkeypatch.setattr(topk, "LEAF_ROWS", 8)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(600, 6))
    v[100:160] = v[0]  # many ties
    rows = [(i, [float(c) for c in x]) for i, x in enumerate(v)]
    bad = [(1000, None), (1020, [1.0, None]), (1040, [float("nan")] * 6), (1060, [float("inf")] * 6), (None, [1.0] * 6), (1080, [])]
    df = spark.createDataFrame(rows + bad + rows[:2], "vec_id long, embedding array<float>")
    df = df.withColumn("score", F.lit("x")).withColumn("v", F.lit(1))
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, 5).collect())
    q = np.floor(v.astype(np.float32).astype(np.float64) * 64).astype(np.int64)
    want = []
    for i in range(0, 600, 20):
        s = q @ q[i]
        best = sorted((j for j in range(600) if j != i), key=lambda j: (-s[j], j))[:5]
        want += [(i, r + 1, j, int(s[j])) for r, j in enumerate(best)]
    assert got == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>")
    assert topk.top_k(few, F.col("vec_id") % 20 == 0, 5).count() == 2


def test_reply_tree_paths_and_ranks(spark):
    #       1 -> 2 -> 3, 2 -> 4 -> 5, 1 -> 6; 7 -> 8 replies to a missing message; 9 and 10 reply to each other
    rows = [(0, 1, None), (0, 2, 1), (0, 3, 2), (0, 4, 2), (0, 5, 4), (0, 6, 1), (0, 7, 99), (0, 8, 7), (0, 9, 10), (0, 10, 9)]
    rows = [(t, n, p, "assistant" if n % 2 == 0 else "user", f"m{n}", float(n)) for t, n, p in rows]
    m = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    paths = {}
    for r in chat.branches(m).collect():
        paths.setdefault(r.leaf, {})[r.back] = r.node
    assert {k: [v[i] for i in sorted(v, reverse=True)] for k, v in paths.items()} == {3: [1, 2, 3], 5: [1, 2, 4, 5], 6: [1, 6], 8: [7, 8]}
    best = [r.formatted for r in chat.format_branches(m, 2).orderBy("rank").collect()]
    assert best == ["### user: m7</turn>\n### assistant: m8</turn>\n", "### user: m1</turn>\n### assistant: m6</turn>\n"]


def test_a_reply_into_a_cycle_ends(spark):
    rows = [(0, 1, 2), (0, 2, 1), (0, 3, 1), (0, 4, 3), (1, 10, None), (1, 11, 10), (2, 20, 20), (2, 21, 20)]
    m = spark.createDataFrame([(*r, "user", f"m{r[1]}", 1.0) for r in rows], "tree long, node long, parent long, role string, text string, score double")
    assert {(r.leaf, r.node, r.back) for r in chat.branches(m).collect()} == {(11, 11, 0), (11, 10, 1)}
    assert [r.formatted for r in chat.format_branches(m).collect()] == ["### user: m10</turn>\n### user: m11</turn>\n"]


def test_only_chosen_branches_of_a_long_thread_are_written(spark, monkeypatch):
    """3 000 messages, each with a side reply of its own: some four million path rows in all, of which one branch is chosen."""
    n = 3000
    rows = [(0, i, i - 1 if i else None, "assistant", "t", 1.0) for i in range(n)]
    rows += [(0, n + i, i, "user", "side", 2.0 if i == n - 1 else 0.0) for i in range(n)]
    m = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    sizes, keep = [], chat.stored

    def counted(df, name="stored"):
        out = keep(df, name)
        sizes.append(out.count() if name == "paths" else 0)
        return out

    monkeypatch.setattr(chat, "stored", counted)
    best = chat.format_branches(m).collect()
    assert len(best) == 1 and best[0].formatted == "### assistant: t</turn>\n" * n + "### user: side</turn>\n"
    assert abs(best[0].score - (n + 2.0) / (n + 1)) < 1e-9 and max(sizes) == n + 1


def test_chat_is_read_back(spark):
    rows = [(c, i, ["user", "assistant", None, "a:b#<\\c"][i % 4], t) for c in (1, 2) for i, t in enumerate(ODD_TEXTS)]
    rows += [(1, 1, "assistant", "same turn"), (1, 1, "assistant", "same turn"), (None, None, None, None), (3, 0, "user", "\\h\\\\l\\c: x")]
    rows += [(4, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(70)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("rank", F.lit("clash"))
    out = {r.tree: r for r in chat.read_back(chat.format_branches(chat.threads(conv))).collect()}
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    assert set(out) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(t[5] for t in turns if t[3] == "assistant")
        assert out[c].n_turns == len(turns) and out[c].loss_chars == len(loss)
        assert out[c].turns_sha256 == hashlib.sha256("".join(f"{t[3]}\n{t[5]}\n" for t in turns).encode()).hexdigest()
        assert out[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert out[c].formatted.count(chat.END) == len(turns) and out[c].formatted_chars == len(out[c].formatted)
    assert chat.format_branches(chat.threads(conv.limit(0))).count() == 0


def signature(text):
    """The same sketches with dictionaries."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x

    def hashed(values, seed=42):
        for x in values:
            data = x.encode() if isinstance(x, str) else (x & ((1 << 8 * size) - 1 if (size := 8) else 0)).to_bytes(8, "little")
            seed = xxhash.xxh64_intdigest(data, seed)
        return seed

    words = [w for w in re.split("[ \t\n\x0b\f\r]+", text) if w]
    if not words:
        return set()
    grams = [words[i : i + 2] for i in range(max(1, len(words) - 1))]
    seen, sketches = {}, {}
    for place, g in enumerate(grams):
        h = signed(hashed(g)) >> 24
        number = seen.get(h, 0)
        seen[h] = number + 1
        e = hashed([h]) if False else xxhash.xxh64_intdigest(number.to_bytes(4, "little"), hashed([h]))
        sketches.setdefault(e >> 58, []).append((signed(e) >> 24, place))
    out = set()
    for b, members in sketches.items():
        two = sorted(sorted(members, key=lambda m: (m[0], m[1]))[:2], key=lambda m: m[1])
        out.add(b * 65536 + signed(hashed([m[0] for m in two])) % 65536)
    return out


def test_fingerprints_equal_brute_force(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(400)]
    texts = [t or "" for t in ODD_TEXTS if not t or len(t) < 6000] + [" ".join(rng.choice(base[:30]) for _ in range(n)) for n in (50, 300, 900)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in df.select("doc_id", order_minhash.signature(F.col("text")).alias("s")).collect():
        assert set(r.s) == signature(texts[r.doc_id]), texts[r.doc_id][:50]


def test_fingerprints_follow_order_and_edits(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(5000)}" for _ in range(600)]
    moved = words[300:] + words[:300]
    shuffled = rng.sample(words, 600)
    edited = [w if rng.random() > 0.02 else "new" for w in words]
    rows = [" ".join(x) for x in (words, moved, shuffled, edited)]
    sig = lambda c: order_minhash.signature(F.col(c))
    df = spark.createDataFrame([(rows[0], r) for r in rows], "a string, b string")
    same, block, none, few = [r[0] for r in df.select(order_minhash.likeness(sig("a"), sig("b"))).collect()]
    assert same == 1.0 and none < 0.1 and few > 0.75 and none < block < few


def test_short_texts_keep_order(spark):
    rng = random.Random(6)
    rows = []
    for n in (10, 30, 120, 600):
        for _ in range(20):
            words = [f"w{rng.randrange(5000)}" for _ in range(n)]
            rows.append((n, " ".join(words), " ".join(words[n // 2 :] + words[: n // 2])))
    df = spark.createDataFrame(rows + [(0, "", ""), (1, "one", "one"), (2, "", "one"), (3, "a b c", "a b c")], "n int, a string, b string")
    out = order_minhash.fingerprints(df.selectExpr("n AS doc_id", "a AS text")).collect()
    assert {len(r.fingerprint.split(".")) for r in out if r.n_chars} == {64}
    sig = lambda c: order_minhash.filled_signature(F.col(c))
    old = lambda c: order_minhash.signature(F.col(c))
    df = df.select("n", order_minhash.likeness(sig("a"), sig("b")).alias("x"), order_minhash.likeness(old("a"), old("b")).alias("y"))
    like = {r.n: (r.x, r.y) for r in df.groupBy("n").agg(F.avg("x").alias("x"), F.avg("y").alias("y")).collect()}
    assert like[0][0] == 1.0 and like[1][0] == 1.0 and like[2][0] == 0.0 and like[3][0] == 1.0
    assert like[10][0] < 0.45 and like[30][0] < 0.55 and like[120][0] < 0.58 and 0.4 < like[600][0] < 0.6


def test_edited_texts(spark):
    docs = odd_docs(spark)
    out = order_minhash.fingerprints(docs).collect()
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    firsts = {}
    for i, t in rows:
        firsts[i] = min(t, firsts.get(i, t))
    ids = sorted(i for i in firsts if i is not None)
    want = set()
    for i, t in rows:
        after = firsts[ids[(ids.index(i) + 1) % len(ids)]] if i is not None else ""
        quarter = len(t) // 4
        want.add((i, len(t), hashlib.sha256((t[: len(t) - quarter] + after[:quarter]).encode()).hexdigest()))
    assert len(out) == len(rows) and {(r.doc_id, r.n_chars, r.edited_sha256) for r in out} == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert order_minhash.fingerprints(empty_docs(spark)).count() == 0


def test_licenses_equal_brute_force(spark):
    rng = random.Random(4)
    notices = dict(licenses.NOTICES)
    texts, want = [], set()
    for i in range(120):
        words = [f"w{rng.randrange(50)}" for _ in range(rng.randrange(0, 60))]
        if i % 3 == 0:
            name = rng.choice(list(notices))
            at = rng.randrange(len(words) + 1)
            words[at:at] = notices[name].upper().split() if i % 2 else notices[name].split()
            want.add((i, name))
        texts.append(" ".join(words))
    texts.append("licensed under the GNU general license without more")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = licenses.scan(docs, licenses.notices(spark)).collect()
    assert {(r.doc_id, r.license) for r in found} == want and all(r.containment == 1.0 for r in found)
    odd = odd_docs(spark)
    assert licenses.scan(odd, licenses.notices(spark)).count() == 0
    assert licenses.scan(empty_docs(spark), licenses.notices(spark)).count() == 0
    assert licenses.scan(docs, licenses.notices(spark).limit(0)).count() == 0


def test_license_texts_in_long_documents(spark):
    rng = random.Random(9)
    known = {}
    for r in licenses.templates(spark).collect():
        if len(r.text) > len(known.get(r.license, "")):
            known[r.license] = r.text
    mit, bsd = known["MIT"], known["BSD"]
    at = bsd.index("THIS SOFTWARE")
    bodies = {
        ("MIT",): mit, ("BSD",): bsd, ("BSD", "BSD-3-Clause"): bsd[:at] + "3. Neither the name of the owner " + known["BSD-3-Clause"] + ". " + bsd[at:],
        **{(x,): known[x] for x in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "ISC", "CC0-1.0")},
        ("GPL-3.0",) * 2: "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        ("LGPL-2.1",) * 2: "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option)",
    }
    noise = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    rows, want = [], {}
    for names, body in bodies.items():
        words = body.split()
        forms = [body, "\n".join("# " + " ".join(words[i : i + 9]) for i in range(0, len(words), 9)).upper()]
        if len(words) > 100:
            edits = {40, *range(100, len(words), 60)}
            forms.append(" ".join("changed" if i in edits else w for i, w in enumerate(words)))
        for form in forms:
            want[len(rows)] = set(names)
            rows.append((len(rows), f"{noise(3000)} {form} {noise(2000)}"))
    rows.append((len(rows), noise(5000)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = {}
    for r in licenses.scan(docs, licenses.templates(spark)).collect():
        assert r.containment >= licenses.CONTAINMENT
        found.setdefault(r.doc_id, set()).add(r.license)
    assert found == want


def test_language_is_learnt_from_training_rows_alone(spark):
    rng = random.Random(6)
    parts = {"en": ["the", "and", "ing", "tion", "er"], "de": ["sch", "und", "ung", "ö", "ei"], "fr": ["eau", "les", "oux", "é", "que"]}
    rows = [(i, " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(rng.randrange(3, 40))), lang) for i in range(300) for lang in [rng.choice(list(parts))]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    truth = {i: lang for i, _, lang in rows}
    out = language.predict(docs).collect()
    held = [r for r in out if r.held_out]
    assert len(held) > 30 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    # labels of held-out rows and the other columns change nothing
    hidden = docs.withColumn("lang", F.when(language.remainder("doc_id", 5) != 0, F.col("lang"))).withColumn("score", F.lit("clash"))
    assert sorted(map(tuple, language.predict(hidden).collect())) == sorted(map(tuple, out))


def test_language_of_odd_rows(spark):
    docs = odd_docs(spark)
    out = language.predict(docs).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.lang_pred is not None for r in out)
    unknown = {r.doc_id for r in out if r.lang_pred == "und"}
    assert {0, 10, 20, 30, 180} <= unknown and 40 not in unknown
    assert language.predict(empty_docs(spark)).count() == 0
    assert {r.lang_pred for r in language.predict(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
