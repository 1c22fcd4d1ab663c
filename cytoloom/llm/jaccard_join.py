"""N-gram Jaccard join: documents whose sets of word shingles are nearly equal, as components.

Method: rare-first prefix filtering with length, positional and suffix filters, joined on
prefix shingles, every surviving pair verified once on the full sets.

1. Texts with the same shingle set form one class; everything below works on classes.
2. Shingles are ordered by document frequency, rarest first. Every task counts the shingles of some
   thousands of documents at a time and reports those that come more than once; of the sums, the most frequent ones
   (MOST_FREQUENT at most) are ranked, all others count as rare. So a passage that many documents share comes last
   in each of them. Any fixed order is correct, a rare-first one is fast.
3. Sets with Jaccard >= t share a shingle among the first n - ceil(t n) + 1 of each.
4. Joining all members of a prefix shingle with each other would grow with the square of a group
   of copies. So first the five most central members of a shingle meet all others. The links found are
   verified and components joined; a shingle whose members are then in one
   component is done: pairs inside a component cannot change the result. The second join pairs what is
   left: members outside the most frequent component of their shingle with members of other components.
   No link between components is lost: two classes sharing a prefix shingle either meet in
   one of the joins or are connected already.
5. The length filter and the positional filter are join conditions. The suffix filter bounds the
   overlap by the counts of both sets in 256 hash parts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cytoloom.llm.components import component_roots
from cytoloom.llm.text import bounded_broadcast, map_batches, mix, packed, shingle_sets
from cytoloom.session import stored

# Shingles whose occurrences a task counts together, and shingles ranked by frequency (16 bytes each on the driver).
COUNTED = 1 << 22
MOST_FREQUENT = 1 << 19
# Parts of the suffix filter.
PARTS = 256
# Members of a shingle that meet all others, before what is left meets fully.
LEADS = 5


def _digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set of shingle hashes."""
    a = np.bitwise_xor.reduce(mix(s + np.uint64(1))) if len(s) else np.uint64(0)
    b = np.add.reduce(mix(s ^ np.uint64(0x5DEECE66D)))
    return int(a.astype(np.int64)), int(np.uint64(b).astype(np.int64))


def _repeated(shingles: np.ndarray) -> pa.RecordBatch:
    """Shingles of more than one of the documents whose sets these are, with the number of documents; sorts in place."""
    shingles.sort()
    again = np.zeros(len(shingles) + 1, np.int8)
    np.equal(shingles[1:], shingles[:-1], out=again[1:-1].view(bool))
    # a run of equal shingles begins where the comparison turns true and ends where it turns false
    turns = np.diff(again)
    starts, ends = np.flatnonzero(turns > 0), np.flatnonzero(turns < 0)
    values, counts = shingles[starts].astype(np.int64), ends - starts + 1
    zeros = pa.array(np.zeros(len(values), np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ones(len(values), np.int32)), pa.array(values), pa.array(counts.astype(np.int64)), zeros, zeros],
        ["kind", "doc_id", "n", "d1", "d2"],
    )


def _signature(docs: DataFrame, k: int) -> DataFrame:
    """Rows of kind 0: (doc_id, set size, digest); of kind 1: (shingle, documents of a part of a task that have it)."""

    def run(batches):
        held, size = np.empty(COUNTED, np.uint64), 0
        for batch in batches:
            n, d1, d2 = [], [], []
            for s in shingle_sets(batch, k):
                a, b = _digest(s)
                n.append(len(s)), d1.append(a), d2.append(b)
                if size + len(s) > COUNTED:
                    yield _repeated(held[:size])
                    size = 0
                if len(s) <= COUNTED:  # a set alone repeats nothing
                    held[size : size + len(s)] = s
                    size += len(s)
            kind = pa.array(np.zeros(len(n), np.int32))
            yield pa.RecordBatch.from_arrays(
                [kind, batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64())],
                ["kind", "doc_id", "n", "d1", "d2"],
            )
        yield _repeated(held[:size])

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run, "kind int, doc_id long, n long, d1 long, d2 long")


def _frequent(signature: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, ascending, with their counts.

    Whole classes of like counts are taken, from the top, while they are at most MOST_FREQUENT in number.
    """
    counts = signature.where("kind = 1").groupBy(F.col("doc_id").alias("shingle")).agg(F.sum("n").alias("n"))
    counts = stored(counts.select("shingle", "n", F.floor(F.log2("n") * 8).alias("class")), "frequent")
    total, floor = 0, None
    for row in counts.groupBy("class").count().orderBy(F.desc("class")).collect():  # 500 rows at most
        total += row["count"]
        if total > MOST_FREQUENT:
            break
        floor = row["class"]
    if floor is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = counts.where(F.col("class") >= floor).select("shingle", "n").toArrow()
    shingles = found["shingle"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], found["n"].to_numpy().astype(np.int64)[order]


def _prefixes(docs: DataFrame, k: int, num: int, den: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Per text with words: set size, digest, its prefix in rare-first order, its counts in PARTS hash parts."""
    known, counts = frequent

    def frequency(s):
        if not len(known):
            return np.zeros(len(s), np.int64)
        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
        return np.where(known[at] == s, counts[at], 0)

    def run(batches):
        for batch in batches:
            n, d1, d2, prefix, parts = [], [], [], [], []
            for s in shingle_sets(batch, k):
                if not len(s):
                    continue
                order = np.lexsort((s, frequency(s)))
                a, b = _digest(s)
                n.append(len(s)), d1.append(a), d2.append(b)
                prefix.append(s[order[: len(s) + (-num * len(s)) // den + 1]].astype(np.int64))
                parts.append(np.bincount((s % np.uint64(PARTS)).astype(np.int64), minlength=PARTS).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                    pa.array(prefix, pa.list_(pa.int64())), pa.array(parts, pa.list_(pa.int32())),
                ],
                ["n", "d1", "d2", "prefix", "parts"],
            )

    return map_batches(docs.select("text"), run, "n long, d1 long, d2 long, prefix array<long>, parts array<int>")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(batch, k))
            digests = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([a for a, _ in digests], pa.int64()),
                    pa.array([b for _, b in digests], pa.int64()),
                    pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["n", "d1", "d2", "shingles"],
            )

    return map_batches(docs.select("text"), run, "n long, d1 long, d2 long, shingles array<long>")


def _may_link(a: str, b: str, num: int, den: int):
    """Length filter and positional filter of two members of one prefix shingle."""
    least, most = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    rest = F.least(F.col(f"{a}.n") - F.col(f"{a}.pos"), F.col(f"{b}.n") - F.col(f"{b}.pos"))
    # overlap >= t / (1 + t) * (n_a + n_b) is necessary for Jaccard >= t
    return (least * den >= most * num) & (rest * (num + den) >= (F.col(f"{a}.n") + F.col(f"{b}.n")) * num)


def _unseen(met: DataFrame, seen: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (u, v, nu, nv) of ``met(a, b)`` in different components that pass the filters, each once and never again."""
    a_first = F.col("a.node") < F.col("b.node")
    pairs = met.where((F.col("a.root") != F.col("b.root")) & _may_link("a", "b", num, den)).select(
        F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v"),
        F.when(a_first, F.col("a.n")).otherwise(F.col("b.n")).alias("nu"), F.when(a_first, F.col("b.n")).otherwise(F.col("a.n")).alias("nv"),
    )
    return stored(pairs.distinct().join(seen, ["u", "v"], "left_anti"), "candidates")


def _main_roots(placed: DataFrame) -> DataFrame:
    """(shingle, main): the most frequent component of every shingle with members of several components."""
    per_root = placed.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("members"))
    found = per_root.groupBy("shingle").agg(F.max(F.struct("members", "root")).alias("most"), F.count(F.lit(1)).alias("roots"))
    return found.where("roots > 1").select("shingle", F.col("most.root").alias("main"))


def _placed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of shingles with their present root."""
    members = members.select("shingle", "node", "n", "pos").join(roots, "node", "left")
    return members.select("shingle", "node", "n", "pos", F.coalesce("root", "node").alias("root"))


def _linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """The candidate pairs, and the links (u, v) among them: suffix filter, then the exact overlap of the full sets."""
    candidates = pairs.select("u", "v")
    parts = classes.select("node", "parts")
    within = F.aggregate(F.zip_with("pu", "pv", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    pairs = stored(
        pairs.join(parts.select(F.col("node").alias("u"), F.col("parts").alias("pu")), "u")
        .join(parts.select(F.col("node").alias("v"), F.col("parts").alias("pv")), "v")
        .where(within * (num + den) >= (F.col("nu") + F.col("nv")) * num)
        .select("u", "v", "nu", "nv"),
        "pairs",
    )
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    members = stored(classes.join(nodes, "node", "left_semi").select("node", "n", "d1", "d2", "doc_id"), "members")
    ids = bounded_broadcast(members.select("doc_id"))
    # several rows may share a doc_id, so sets come back by digest; rows without a doc_id are all read
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.join(ids, "doc_id", "left_semi").union(texts.where("doc_id IS NULL"))
    sets = (
        _sets(texts, k)
        .join(members, ["n", "d1", "d2"])
        .groupBy("node")
        .agg(F.first("shingles").alias("shingles"))
    )
    sets = stored(sets, "sets")
    both = F.size(F.array_intersect("su", "sv"))
    links = (
        pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("su")), "u")
        .join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv")), "v")
        .where(both * den >= (F.col("nu") + F.col("nv") - both) * num)
        .select("u", "v")
    )
    return candidates, links


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id) of ``docs(doc_id, text)``, one row per row.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. A text with fewer
    than ``k`` words is one shingle; a null text or one without words has none and
    links with nothing. Two texts link when ``intersection / union >= num / den``, and
    ``component_id`` is the smallest doc_id reachable. Texts of any length are taken whole. Repeated rows
    each return a row; rows that share a doc_id with different texts are documents of their own. A null doc_id
    takes part and gets the smallest id of its component, null when it has none. Other columns
    of ``docs`` are ignored, whatever their names; an empty table gives an empty table.
    """
    return _components(docs, k, num, den).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _components(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(doc_id, n, d1, d2, root, component_id) per row: its shingle count and digest, a number of its component and the
    smallest doc_id there; both are null without words."""
    signature = stored(_signature(docs, k), "signature")
    rows = signature.where("kind = 0").select("doc_id", "n", "d1", "d2")
    key = ["n", "d1", "d2"]
    ids = rows.where("n > 0").groupBy(*key).agg(F.min("doc_id").alias("doc_id"))
    # one text per class is enough; all its texts have the same prefix
    classes = stored(
        _prefixes(docs, k, num, den, _frequent(signature))
        .groupBy(*key)
        .agg(F.first("prefix").alias("prefix"), F.first("parts").alias("parts"))
        .join(ids, key)
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    entries = classes.select("node", "n", F.posexplode("prefix").alias("pos", "shingle"))
    shared = stored(entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "shared")
    # entries of shingles that only one class has go here; the few others are stored
    entries = stored(entries.join(shared, "shingle"), "entries")
    # An original shares all its shingles with its copies, a copy also has rare ones of its own. So members
    # whose shingles are shared most lead; the limit by rank is applied in every task before the shuffle.
    weights = entries.groupBy("node").agg(F.sum("members").alias("weight"))
    by_weight = Window.partitionBy("shingle").orderBy(F.desc("weight"), "node")
    leads = entries.join(weights, "node").withColumn("rank", F.row_number().over(by_weight)).where(F.col("rank") <= LEADS)
    leads = stored(leads.select("shingle", "node", "n", "pos"), "leads")

    nothing = entries.select(F.col("node").alias("u"), F.col("node").alias("v")).where("false")
    roots = nothing.select(F.col("u").alias("node"), F.col("v").alias("root"))
    member = F.struct("node", "n", "pos", "root")
    # the leading members of a shingle meet all others
    a = _placed(leads, roots).select("shingle", member.alias("a"))
    met = _placed(entries, roots).select("shingle", member.alias("b")).join(a, "shingle")
    seen, found = _linked(_unseen(met, nothing, num, den), classes, docs, k, num, den)
    links = stored(found, "links")
    # what is left: shingles whose members are still in several components
    placed = stored(_placed(entries, component_roots(links)), "placed")
    rest = placed.join(_main_roots(placed), "shingle").select("shingle", member.alias("m"), (F.col("root") == F.col("main")).alias("main"))
    rest = stored(rest, "open")
    a = rest.where("NOT main").select("shingle", F.col("m").alias("a"))
    b = rest.select("shingle", F.col("m").alias("b"), F.col("main"))
    met = a.join(b, "shingle").where((F.col("a.root") != F.col("b.root")) & (F.col("main") | (F.col("a.node") < F.col("b.node"))))
    _, found = _linked(_unseen(met.select("a", "b"), seen, num, den), classes, docs, k, num, den)
    links = links.union(found)
    roots = component_roots(links)
    placed = classes.select("node", *key, "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = placed.join(least, "root").select(*key, "root", "component_id")
    return rows.join(found, key, "left").select("doc_id", *key, "root", "component_id")


def drop_near_copies(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The documents with one of each component left, all columns kept.

    The document with the smallest doc_id stays. Rows that share a doc_id are one document, of
    which the row with the smallest text stays. Rows without a doc_id cannot be named and stay.
    """
    found = stored(jaccard_components(docs, k, num, den), "components")
    ids = found.where("doc_id IS NOT NULL").groupBy("doc_id")
    fate = stored(
        ids.agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("component_id") < F.col("doc_id")).alias("gone")), "fate"
    )
    gone = bounded_broadcast(stored(fate.where("gone").select("doc_id"), "gone"))
    rows = packed(docs)
    left = rows.join(gone, F.col("row.doc_id") == gone["doc_id"], "left_anti")
    repeated = stored(fate.where("rows > 1 AND NOT gone").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return left.select("row.*")
    repeated = bounded_broadcast(repeated)
    same = F.col("row.doc_id") == repeated["doc_id"]
    one = (
        left.join(repeated, same, "left_semi")
        .groupBy("row.doc_id")
        .agg(F.min_by("row", F.coalesce("row.text", F.lit(""))).alias("row"))
    )
    return left.join(repeated, same, "left_anti").union(one.select("row")).select("row.*")


def _digested(rows: DataFrame, k: int) -> DataFrame:
    """``rows(row)`` with shingle count and digest of the text of every row."""

    def run(batches):
        for batch in batches:
            found = pa.record_batch({"text": pc.struct_field(batch.column("row"), "text")})
            keys = [(len(s), *_digest(s)) for s in shingle_sets(found, k)]
            columns = [pa.array([x[i] for x in keys], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], ["row", "n", "d1", "d2"])

    return map_batches(rows, run, StructType([rows.schema["row"], *[StructField(c, LongType()) for c in ("n", "d1", "d2")]]))


def drop_near_copy_rows(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows with one of each component left, all columns kept.

    Every row is judged by its own text, whatever its doc_id: rows that share a doc_id with unlike texts all stay, and of
    near copies without a doc_id one stays. The row with the smallest doc_id stays, a null one last; of its rows with
    the same shingles that with the smallest text. Rows without words have no copies and stay.
    """
    key = ["n", "d1", "d2"]
    found = stored(_components(docs, k, num, den), "components")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", *key)
    kept = found.where("root IS NOT NULL").groupBy("root").agg(F.min(order).alias("kept"))
    kept = stored(kept.select("root", "kept.*"), "kept")
    many = stored(found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id"), "repeated")
    plain = found.where("doc_id IS NOT NULL").join(many, "doc_id", "left_anti")
    lost = plain.join(kept.select("root", F.col("doc_id").alias("kept_id")), "root").where("NOT doc_id <=> kept_id")
    lost = bounded_broadcast(stored(lost.select("doc_id"), "gone"))
    rows, doc_id = packed(docs), F.col("row.doc_id").cast("long")
    left = rows.join(lost, doc_id == lost["doc_id"], "left_anti")
    if many.isEmpty() and found.where("doc_id IS NULL").isEmpty():
        return left.select("row.*")
    many = bounded_broadcast(many)
    single = left.where(doc_id.isNotNull()).join(many, doc_id == many["doc_id"], "left_anti")
    unsure = rows.where(doc_id.isNull()).union(rows.join(many, doc_id == many["doc_id"], "left_semi"))
    # a repeated or missing id does not name a row: these are told apart by id and digest
    unsure = stored(_digested(unsure, k), "unsure")
    same = [doc_id.eqNullSafe(kept["doc_id"]), *[unsure[c] == kept[c] for c in key]]
    one = unsure.join(kept, same).groupBy("root").agg(F.min_by("row", F.coalesce("row.text", F.lit(""))).alias("row"))
    return single.union(unsure.where("n = 0").select("row")).union(one.select("row")).select("row.*")
