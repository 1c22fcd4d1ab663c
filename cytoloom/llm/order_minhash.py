"""Document fingerprints by Order MinHash.

The elements of a text are its word k-mers, each numbered by its occurrence, so that a repeated k-mer is
several elements. A fingerprint has 64 sketches: the hash of an element deals it to a sketch and ranks it there, the
two smallest elements of a sketch are put back into text order, and the ordered pair is hashed. Two texts agree in a
sketch only if they share both elements in the same order, so the share of equal sketches follows edit distance and not
only the common content. A short text deals fewer than two elements to many sketches; such a sketch takes its pair from
all elements, in a permutation of its own, so its two minima are put in text order as well.

All of it is array work inside the row of a document: nothing is exploded or shuffled for a fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoloom.session import stored

K = 2
SKETCH_BITS = 6
# Packed numbers: high bits rank, low bits hold the position of a k-mer.
PLACE_BITS = 24
PLACES = (1 << PLACE_BITS) - 1
WORD_SPLIT = "[ \\t\\n\\u000B\\f\\r]+"


def _with(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once per row."""
    return F.transform(F.array(F.struct(value.alias("v"))), lambda s: fn(s["v"]))[0]


def _kmers(text: Column) -> Column:
    """Hashes of the word k-mers, their low bits replaced by the position; fewer than k words are one k-mer."""
    words = F.filter(F.split(text, WORD_SPLIT, -1), lambda w: w != "")

    def of(w: Column) -> Column:
        def packed(i: Column) -> Column:
            h = F.xxhash64(*[F.get(w, i + j) for j in range(K)])
            return h.bitwiseAND(F.lit(~PLACES)).bitwiseOR(i.cast("long"))

        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - K, F.lit(0))), packed)
        )

    return _with(words, of)


def _same(a: Column, b: Column) -> Column:
    """Whether two packed numbers have the same high bits."""
    return F.shiftright(a, PLACE_BITS) == F.shiftright(b, PLACE_BITS)


def _elements(kmers: Column) -> Column:
    """Occurrence-numbered k-mers as packed numbers: sketch, rank inside the sketch, position; sorted."""

    def numbered(s: Column) -> Column:
        steps = F.array(*[F.lit(1 << b) for b in range(PLACE_BITS - 1, -1, -1)])

        def element(x: Column, i: Column) -> Column:
            # equal k-mers stand together in order of position: the number is the distance to the first,
            # found by halving steps, and only where there is an equal one just before
            distance = F.aggregate(
                steps, F.lit(0), lambda d, b: F.when((i - d - b >= 0) & F.coalesce(_same(F.get(s, i - d - b), x), F.lit(False)), d + b).otherwise(d)
            )
            number = F.when((i > 0) & F.coalesce(_same(F.get(s, i - 1), x), F.lit(False)), distance).otherwise(F.lit(0))
            h = F.xxhash64(F.shiftright(x, PLACE_BITS), number)
            return h.bitwiseAND(F.lit(~PLACES)).bitwiseOR(x.bitwiseAND(F.lit(PLACES)))

        return F.transform(s, element)

    return F.sort_array(_with(F.sort_array(kmers), numbered))


def _sketch_of(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - SKETCH_BITS)


def _dealt(elements: Column, alone: bool) -> Column:
    """Sketches with two dealt elements, or ``alone`` with at least one, as numbers: the sketch in the high digits,
    16 bits of the hash of its ordered pair below."""

    def smallest(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i < 2) | F.coalesce(_sketch_of(F.get(s, i - 2)) != _sketch_of(x), F.lit(True)))

    def pairs(s: Column) -> Column:
        def sketch(x: Column, i: Column) -> Column:
            nxt = F.get(s, i + 1)
            paired = F.coalesce(_sketch_of(nxt) == _sketch_of(x), F.lit(False))
            in_order = x.bitwiseAND(F.lit(PLACES)) <= nxt.bitwiseAND(F.lit(PLACES))
            a, b = F.shiftright(x, PLACE_BITS), F.shiftright(nxt, PLACE_BITS)
            h = F.when(~paired, F.xxhash64(a)).when(in_order, F.xxhash64(a, b)).otherwise(F.xxhash64(b, a))
            first = (i == 0) | F.coalesce(_sketch_of(F.get(s, i - 1)) != _sketch_of(x), F.lit(True))
            return F.when(first if alone else first & paired, _sketch_of(x) * 65536 + F.pmod(h, F.lit(65536)))

        return F.filter(F.transform(s, sketch), lambda x: x.isNotNull())

    return _with(_with(elements, smallest), pairs)


def signature(text: Column) -> Column:
    """The sketches that got an element; one that got a single element says nothing about order."""
    return _dealt(_elements(_kmers(text)), True)


def filled_signature(text: Column) -> Column:
    """All sketches of a text with words: those with fewer than two dealt elements are filled from all of them."""

    def fill(elements: Column) -> Column:
        def own(b: Column) -> Column:
            ranks = F.transform(elements, lambda x: F.xxhash64(F.shiftright(x, PLACE_BITS), b).bitwiseAND(F.lit(~PLACES)).bitwiseOR(x.bitwiseAND(F.lit(PLACES))))

            def pair(two: Column) -> Column:
                x, y = F.get(two, F.lit(0)), F.get(two, F.lit(1))
                a, c = F.shiftright(x, PLACE_BITS), F.shiftright(y, PLACE_BITS)
                in_order = x.bitwiseAND(F.lit(PLACES)) <= y.bitwiseAND(F.lit(PLACES))
                h = F.when(y.isNull(), F.xxhash64(a)).when(in_order, F.xxhash64(a, c)).otherwise(F.xxhash64(c, a))
                return b * 65536 + F.pmod(h, F.lit(65536))

            return _with(F.slice(F.sort_array(ranks), 1, 2), pair)

        def rest(dealt: Column) -> Column:
            every = F.array(*[F.lit(b).cast("long") for b in range(1 << SKETCH_BITS)])
            missing = F.array_except(every, F.transform(dealt, lambda x: F.shiftright(x, 16)))
            return F.when(F.size(elements) == 0, dealt).otherwise(F.sort_array(F.concat(dealt, F.transform(missing, own))))

        return _with(_dealt(elements, False), rest)

    return _with(_elements(_kmers(text)), fill)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal sketches among those filled in either signature; 1 for two empty ones."""
    sketch = lambda x: F.shiftright(x, 16)
    filled = F.size(F.array_union(F.transform(a, sketch), F.transform(b, sketch)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled)


def as_text(sig: Column) -> Column:
    return F.array_join(F.transform(sig, lambda x: F.lower(F.hex(x))), ".")


def successors(docs: DataFrame) -> DataFrame:
    """(doc_id, next_id, first) over distinct doc_ids: the next larger one, for the largest the smallest.

    Ids are range-partitioned and numbered by partition, so no task sees all of them; the text is not read.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    parts = stored(
        ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id").withColumn("part", F.spark_partition_id()), "ids"
    )
    inner = Window.partitionBy("part").orderBy("doc_id")
    follow = parts.withColumn("next_id", F.lead("doc_id").over(inner))
    # one row per partition: the first id of the partition behind it
    firsts = parts.groupBy("part").agg(F.min("doc_id").alias("first_id"))
    order = Window.orderBy("part")
    firsts = firsts.select("part", F.lead("first_id").over(order).alias("behind"), F.min("first_id").over(Window.partitionBy()).alias("least"))
    return follow.join(F.broadcast(firsts), "part").select("doc_id", F.coalesce("next_id", "behind", "least").alias("next_id"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row.

    The edited text ends with the first code points of the next document, in order of doc_id, instead of its own last
    quarter. A null text counts as empty. Rows that share a doc_id have the same next document; where the next
    doc_id has several rows, the smallest text counts. A row without doc_id has no next document: an empty text
    stands for it. Other columns are ignored, an empty table gives an empty table.
    """
    # a cast that changes nothing leaves an alias on one side of the self-join, and its shuffle is then not reused
    doc_id = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    rows = docs.select(doc_id, F.coalesce("text", F.lit("")).alias("text"))
    order = stored(successors(docs), "next")
    needed = (
        rows.select("doc_id", F.floor(F.char_length("text") / 4).cast("int").alias("need"))
        .groupBy("doc_id").agg(F.max("need").alias("need"))
        .join(order, "doc_id")
        .select(F.col("doc_id").alias("before"), F.col("next_id").alias("doc_id"), "need")
    )
    # the start of every document, as long as the document before it needs it; both joins read one shuffle of the texts
    known = rows.where("doc_id IS NOT NULL")
    starts = (
        known.join(needed, "doc_id")
        .select(F.col("before").alias("doc_id"), F.expr("substring(text, 1, need)").alias("start"))
        .groupBy("doc_id").agg(F.min("start").alias("start"))
    )
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.coalesce("start", F.lit("")), F.lit(1), quarter))
    known = known.join(starts, "doc_id", "left").union(rows.where("doc_id IS NULL").withColumn("start", F.lit("")))
    both = known.select("doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    signed = stored(
        both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), filled_signature(F.col("text")).alias("sig"), filled_signature(F.col("edited")).alias("esig"), F.xxhash64("text").alias("hash")),
        "signed",
    )
    following = (
        signed.groupBy("doc_id").agg(F.min_by("sig", "hash").alias("next_sig"))
        .join(order.select(F.col("doc_id").alias("before"), F.col("next_id").alias("doc_id")), "doc_id")
        .select(F.col("before").alias("doc_id"), "next_sig")
    )
    empty = F.array().cast("array<bigint>")
    return signed.join(following, "doc_id", "left").select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("sig")).alias("fingerprint"), as_text(F.col("esig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("esig")).alias("near_edited"),
        likeness(F.col("sig"), F.coalesce("next_sig", empty)).alias("near_next"),
    )
