"""Quality rules: a threshold table compiled into one projection.

A rule bounds the ratio of two whole numbers measured on a text (symbols per word, stop words per word, duplicate
lines per line, ...). ``RULES`` is the table; ``compiled`` turns any such table into a single struct
column, so all rules are judged while a row passes through one projection: no shuffle, no user
function, and integer comparisons only, so equal texts always get equal verdicts.

Words are maximal runs of other characters than space and \\t \\n \\v \\f \\r. A null text has no words.
Whole texts are measured; the work and memory of a text grow with its length (its repeated windows are found by a
sort). Every row, also a repeated one or one without an id, gets a row; other columns of the input
are neither read nor able to clash.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoloom.llm.text import packed

SPACE = "\\x20\\x09-\\x0D"
SYMBOLS = "#*$%&|<>"
# Words of a window that may not come twice.
WINDOW = 8
# Punctuation at the edges of a stop word.
EDGES = ".,;:!?\"'()"

# The most usual function words of four languages.
STOP_WORDS = {
    "en": "the of and to a in is that for it was on with be as by this are at from or an have not he".split(),
    "fr": "de la le et les des en un du une que pour est qui dans par pas au sur avec ce il se ne plus".split(),
    "de": "der die und in den von zu das sich mit auf des für ist nicht im dem ein eine als auch es an er".split(),
    "es": "de la que el en y los se del las por un no con su una es para al lo como más o pero sus".split(),
}


class Rule(NamedTuple):
    """``low <= 100 * part / whole <= high``; an open side is None. A whole of 0 breaks no rule."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None


# Percent of the measure named last. Fixed values, in the ranges usual for web text.
RULES = [
    Rule("word_length", "word_chars", "n_words", low=250, high=1500),
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule("letters", "n_letter_words", "n_words", low=70),
    Rule("capitals", "n_capitals", "word_chars", high=50),
    Rule("stop_words", "n_stop_words", "n_stop_base", low=2),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=30),
    Rule("cut_lines", "n_cut_lines", "n_lines", high=30),
    Rule("bullets", "n_bullets", "n_lines", high=90),
]
# The base rules: fewest words, and the largest percentage of words in repeated windows.
FEWEST_WORDS = 20
MOST_REPEATED = 30


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with the value computed once, however often ``fn`` uses it."""
    return F.transform(F.array(value), fn)[0]


def _count(items: Column, holds: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(items, holds)).cast("long")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words inside windows of ``window`` words that come twice or more in the same text.

    Equal windows have equal hashes, so a text whose window hashes all differ is done. In the others
    the windows with an equal hash are sorted with their words, and words decide.
    """

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - window)
        return let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(
            starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)])))

    def repeated(sorted_rows: Column, key: str) -> Column:
        """Rows that have the key of the row before or after them."""

        def like(r: Column, i: Column) -> Column:
            return F.coalesce(F.get(sorted_rows, i)[key] == r[key], F.lit(False))

        return F.filter(sorted_rows, lambda r, i: like(r, i - 1) | like(r, i + 1))

    def covered(twice: Column) -> Column:
        return F.aggregate(
            F.array_sort(F.transform(twice, lambda r: r["at"])),
            F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last")),
            lambda acc, at: F.struct((acc["n"] + F.least(at - acc["last"], F.lit(window))).alias("n"), at.alias("last")),
            lambda acc: acc["n"].cast("long"),
        )

    def compared(w: Column, hashed: Column) -> Column:
        suspects = let(F.sort_array(hashed), lambda rows: repeated(rows, "hash"))
        named = F.transform(suspects, lambda r: F.struct(
            r["hash"], F.concat_ws(" ", *[F.get(w, r["at"] + k) for k in range(window)]).alias("words"), r["at"]))
        return let(F.sort_array(named), lambda rows: covered(repeated(rows, "words")))

    def found(w: Column) -> Column:
        return let(hashes(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(
            compared(w, F.transform(h, lambda x, i: F.struct(x.alias("hash"), i.alias("at"))))))

    none = F.lit(0).cast("long")
    return let(words, lambda w: F.when(F.size(w) <= window, none).otherwise(found(w)))


def measures(text: Column, lang: Column) -> Column:
    """Struct of all counts of a text, in whole numbers.

    Stop words are looked for in all lists together; a language without a list (``lang`` set to
    another value) has ``n_stop_base`` 0, so that no stop-word rule applies to it.
    """
    stop = sorted({w for ws in STOP_WORDS.values() for w in ws})

    def of_text(t: Column) -> Column:
        return let(F.array_remove(F.split(t, f"[{SPACE}]+"), ""), lambda words: let(
            F.filter(F.split(t, "\n", -1), lambda line: line.rlike(f"[^{SPACE}]")), lambda lines: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                (F.size(F.split(t, f"[{SYMBOLS}]", -1)) - 1).cast("long").alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                repeated_words(words).alias("n_repeat_words"),
                F.size(lines).cast("long").alias("n_lines"),
                _count(words, lambda w: w.rlike("\\p{L}")).alias("n_letter_words"),
                (F.size(F.split(t, "\\p{Lu}", -1)) - 1).cast("long").alias("n_capitals"),
                _count(words, lambda w: F.lower(F.translate(w, EDGES, "")).isin(stop)).alias("n_stop_words"),
                F.when(F.coalesce(lang.isin(list(STOP_WORDS)), F.lit(True)), F.size(words)).otherwise(0).cast("long").alias("n_stop_base"),
                _count(lines, lambda s: s.rlike(f"(\\.\\.\\.|…)[{SPACE}]*\\z")).alias("n_cut_lines"),
                _count(lines, lambda s: s.rlike(f"\\A[{SPACE}]*[-*•]")).alias("n_bullets"),
            )))

    return let(F.coalesce(text, F.lit("")), of_text)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < FEWEST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])


def compiled(m: Column, rules: list[Rule]) -> Column:
    """Names of the rules that the measures ``m`` break, in the order of the table, comma-joined."""

    def broken(r: Rule) -> Column:
        sides = [100 * m[r.part] < r.low * m[r.whole]] if r.low is not None else []
        sides += [100 * m[r.part] > r.high * m[r.whole]] if r.high is not None else []
        return (m[r.whole] > 0) & reduce(Column.__or__, sides)

    return F.concat_ws(",", *[F.when(broken(r), F.lit(r.name)) for r in rules])


def judged(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """``row`` (the input row), ``m`` (its measures), ``base_failed``, ``broken`` and ``kept``."""
    lang = F.col("row.lang") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = packed(docs).select("row", measures(F.col("row.text"), lang).alias("m"))
    rows = rows.select("row", "m", base_failed(F.col("m")).alias("base_failed"), compiled(F.col("m"), rules or RULES).alias("broken"))
    return rows.select("*", (~F.col("base_failed") & (F.col("broken") == "")).alias("kept"))


def scores(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per document: doc_id, every measure, ``base_failed``, ``kept`` and the names of broken rules."""
    return judged(docs, rules).select(F.col("row.doc_id").alias("doc_id"), "m.*", "base_failed", "kept", "broken")


def keep_good(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """The documents that pass the base rules and the table, with their own columns."""
    return judged(docs, rules).where("kept").select("row.*")
