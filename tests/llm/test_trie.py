"""The prefix trie against plain Python, its queue, and its shards."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from cytoloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_threads(rows, heads=True):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            by[conv].append(((turn is not None, turn or 0, role, sha(f"{len(role)}:{role}{text}")), role, text))
    own = {c: [t[1:] for t in sorted(v)] for c, v in by.items()}
    if not heads:
        return own
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        leader = c - int(abs(c) % 20 * (1 if c >= 0 else -1))
        out[c] = own.get(leader, [])[:h] + turns[h:]
    return out


def plain_trie(threads):
    members = defaultdict(list)
    for c, turns in threads.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(re.findall("[^\x20\x09-\x0d]+", path[-1][1])) if path else 0
        leaves[path] = sum(leaves[p] for p in children[path]) or 1
        saved[path] = own + sum(saved[p] for p in children[path])
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
         sha(",".join(map(str, sorted(c for c in m if len(threads[c]) == len(p))))))
        for p, m in members.items()
    )


def random_rows(seed, convs=300, words=3):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-60, 900), convs):
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "user", None]), rng.choice(["hi you", "a b c", "", None, "x " * rng.randrange(words)])))
    return rows


def rows_of(df):
    key = lambda r: (r[0], r[1])
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=key)


@pytest.mark.parametrize(("shard", "fanout", "queue"), [(1000, 1000, 100_000), (1, 2, 1), (3, 4, 5), (20, 1000, 2)])
def test_trie_equals_plain_python(spark, shard, fanout, queue):
    rows = random_rows(shard)
    turns = trie.shared_heads(trie.numbered(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    assert rows_of(trie.prefix_trie(turns, shard, fanout, queue)) == plain_trie(plain_threads(rows))


def test_without_shared_heads(spark):
    rows = random_rows(9)
    turns = trie.with_starts(trie.numbered(spark.createDataFrame(rows, SCHEMA)))
    assert rows_of(trie.prefix_trie(turns, 5, 3, 4)) == plain_trie(plain_threads(rows, heads=False))


def test_copies_and_a_deep_conversation(spark, monkeypatch):
    """A third of all conversations are copies of one; one conversation has thousands of turns."""
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 8000, 20) for t in range(2)]
    rows += [(c, 0, "user", f"other {c}") for c in range(10_000, 18_000, 20)]
    rows += [(20_000, t, "user", f"turn {t}") for t in range(4000)]
    monkeypatch.setattr(trie, "PIECE_IDS", 7)
    turns = trie.shared_heads(trie.numbered(spark.createDataFrame(rows, SCHEMA)))
    assert rows_of(trie.prefix_trie(turns, 50, 10, 10)) == plain_trie(plain_threads(rows))


def test_queue_spills_and_keeps_its_order():
    rng = random.Random(1)
    messages = [(rng.randrange(-5, 0), bytes([rng.randrange(4)]) * 16, rng.randrange(9), i) for i in range(500)]
    queue = trie.SpillingQueue(limit=16)
    for m in messages:
        queue.push(m)
    assert len(queue.heap) <= 16 and len(queue.runs) > 10
    for key in sorted({m[:2] for m in messages}):
        assert sorted(queue.take(*key)) == sorted(m for m in messages if m[:2] == key)
    assert not queue.heap and not queue.runs


def test_odd_rows_and_empty_tables(spark):
    schema = f"{SCHEMA}, node long, depth string, parent long, last int, pos long"
    pad = (None,) * 5
    rows = [
        (None, 0, "user", "lost"), (40, None, None, None), (40, None, None, None), (41, 7, "a", "b c"), (45, 1, "", "x" * 5000), (45, 1, "", "x" * 5000),
        (46, 0, "user", "word " * 20_000), (47, 0, "1", "2:x"), (48, 0, "12", ":x"), (49, -3, "ü", "😀 \x0b é"), (-41, 0, "u", "v"), (-40, 0, "u", "v"),
    ]
    df = spark.createDataFrame([r + pad for r in rows], schema)
    assert rows_of(trie.prefix_trie(trie.shared_heads(trie.numbered(df)))) == plain_trie(plain_threads(rows))
    empty = spark.createDataFrame([], SCHEMA)
    out = trie.prefix_trie(trie.shared_heads(trie.numbered(empty)))
    assert out.columns == COLUMNS and out.count() == 0
