"""Secret scans: fixed patterns, and a battery of randomness tests over long tokens.

Base spans come from three patterns: assignments to a secret-like name, access keys, hex strings.
The battery then looks at every other token of 20 or more key characters. The narrowest alphabet that
holds the token (digits, hex, base32, letters and digits, base64) is its inferred encoding. Three tests
ask whether the token could be uniform draws from it: chi-squared uniformity of the alphabet, runs
above and below the middle of the alphabet, and the correlation of neighbours. The smallest of their three
p values, corrected for being the smallest of three, is the token's p value.

Random tokens have p values spread over 0 to 1, ordinary words pile up near 0. Short tokens give the tests
little power, so the cut is made per encoding and length class: the p values over LEVEL, which lies above every
cut, tell how many random tokens a class holds, hence how many of those above any cut are not random, and
the smallest cut with a false-discovery share of at most FDR is taken. One is added to the count over LEVEL: without it a
class of few keys, none of which happens to lie there, would report nothing. A class of fewer than POOLED tokens takes
the cut of its whole encoding where that is smaller. The classes are counted over all documents; the addition lets
at most 1 / (1 - LEVEL) more ordinary tokens of a class pass, whatever the size of the corpus.

Everything is DataFrame work without shuffling texts: the spans of a document are arrays in its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoloom.llm.text import packed
from cytoloom.session import stored

# Base patterns: fixed values.
ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{12,}"  # the longest run behind AKIA, 16 characters at least
HEX = "[0-9a-f]{32,}"
# Tokens the battery looks at.
TOKEN = "[A-Za-z0-9+/_=-]{20,}"
FDR = 0.1
CUTS = [i / 50 for i in range(1, 26)]
LEVEL = 0.6
# Strata with fewer tokens look at their encoding too.
POOLED = 50
SYMBOLS = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/"
# name, pattern of a whole token, the alphabet in its own order
ENCODINGS = [
    ("digits", "[0-9]+", "0123456789"),
    ("hex", "[0-9a-f]+", "0123456789abcdef"),
    ("upperhex", "[0-9A-F]+", "0123456789ABCDEF"),
    ("base32", "[A-Z2-7]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("upper", "[A-Z0-9]+", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("lower", "[a-z0-9]+", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base64", ".*", SYMBOLS),
]
KINDS = ["assign", "access", "hex", "random"]


def _spans(text: Column, pattern: str, group: int | None = None) -> Column:
    """(start, end, size) of the leftmost non-overlapping matches, in code points; size is that of ``group``."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    lengths = F.arrays_zip(
        F.transform(between, lambda x: F.char_length(x)).alias("gap"),
        F.transform(found, lambda x: F.char_length(x)).alias("size"),
        F.transform(inner, lambda x: F.char_length(x)).alias("inner"),
    )
    empty = F.array().cast("array<struct<start:int,end:int,size:int>>")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), (start + x["size"]).alias("end"), x["inner"].alias("size"))
        return F.struct((start + x["size"]).alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    walk = F.aggregate(F.slice(lengths, 1, F.greatest(F.size(found), F.lit(0))), start, add, lambda acc: acc["spans"])
    # most texts have no match and need no walk
    return F.when(text.rlike(pattern), walk).otherwise(empty)


def _normal_tail(z: Column) -> Column:
    """P(|N(0, 1)| >= z) by a rational approximation with an error below 2e-7 (fixed constants)."""
    x = F.abs(z) / 2**0.5
    t = 1 / (1 + x * 0.3275911)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return poly * F.exp(-x * x)


def _battery(token: Column) -> Column:
    """(encoding, length class, p) of a token."""
    size = F.char_length(token).cast("double")
    kind = F.lit(len(ENCODINGS) - 1)
    for i in range(len(ENCODINGS) - 2, -1, -1):
        kind = F.when(token.rlike("^" + ENCODINGS[i][1] + "$"), i).otherwise(kind)
    alphabet = F.element_at(F.array(*[F.lit(a) for _, _, a in ENCODINGS]), kind + 1)

    def tested(given: Column) -> Column:
        tok, letters = given["token"], given["alphabet"]
        n, a = F.char_length(tok).cast("double"), F.char_length(letters).cast("double")
        # symbols outside the alphabet (-, _, =) count with its last one
        codes = F.transform(
            F.filter(F.split(tok, ""), lambda c: c != ""),
            lambda c: F.coalesce(F.nullif(F.instr(letters, c), F.lit(0)), F.char_length(letters)).cast("double"),
        )

        def with_codes(g: Column) -> Column:
            v = g["codes"]
            squares = F.aggregate(
                F.sequence(F.lit(1), F.char_length(letters)), F.lit(0.0),
                lambda s, i: s + F.pow(F.size(F.filter(v, lambda c: c == i)).cast("double"), F.lit(2.0)),
            )
            chi, df = squares * a / n - n, a - 1
            # Wilson-Hilferty: the cube root of chi-squared over its degrees of freedom is nearly normal;
            # with few draws per symbol the exact variance 2 df (n - 1) / n narrows it
            z_chi = (chi - df) / F.sqrt(2 * df * (n - 1) / n)
            z_chi = F.when(n >= 5 * a, (F.pow(F.greatest(chi, F.lit(1e-9)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))).otherwise(z_chi)
            pairs = F.zip_with(F.slice(v, 1, F.size(v) - 1), F.slice(v, 2, F.size(v) - 1), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
            high = F.size(F.filter(v, lambda c: c > a / 2)).cast("double")
            turns = F.size(F.filter(pairs, lambda p: (p["x"] > a / 2) != (p["y"] > a / 2))).cast("double") + 1
            product = 2 * high * (n - high)
            z_runs = F.when(
                (high > 0) & (high < n),
                (turns - (product / n + 1)) / F.sqrt(F.greatest(product * (product - n) / (n * n * (n - 1)), F.lit(1e-9))),
            ).otherwise(F.lit(9.0))
            mean = F.aggregate(v, F.lit(0.0), lambda s, c: s + c) / n
            spread = F.aggregate(v, F.lit(0.0), lambda s, c: s + (c - mean) * (c - mean))
            joint = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["x"] - mean) * (p["y"] - mean))
            z_serial = F.when(spread > 0, (joint / spread + 1 / n) * F.sqrt(n)).otherwise(F.lit(9.0))
            # one-sided: too even an alphabet is no evidence against the randomness of a key
            p_chi = F.when(z_chi > 0, _normal_tail(z_chi) / 2).otherwise(1 - _normal_tail(z_chi) / 2)
            least = F.least(p_chi, _normal_tail(z_runs), _normal_tail(z_serial))
            return 1 - F.pow(1 - least, F.lit(3.0))

        return F.transform(F.array(F.struct(codes.alias("codes"))), with_codes)[0]

    p = F.transform(F.array(F.struct(token.alias("token"), alphabet.alias("alphabet"))), tested)[0]
    length_class = F.least(F.floor(F.log2(size / 20) * 2), F.lit(8)).cast("int")
    return F.struct((kind * 100 + length_class).cast("int").alias("stratum"), p.alias("p"))


def _found(text: Column) -> Column:
    """All base spans and all tested tokens of a text."""

    def of_kind(spans: Column, kind: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    assign = F.filter(_spans(text, ASSIGN, 2), lambda s: s["size"] >= 8)
    base = F.concat(of_kind(assign, 0), of_kind(_spans(text, ACCESS), 1), of_kind(_spans(text, HEX), 2))
    tokens = F.transform(
        _spans(text, TOKEN),
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end"),
            _battery(F.substring(text, s["start"] + 1, s["end"] - s["start"])).alias("test"),
        ),
    )
    return F.struct(F.array_sort(base).alias("base"), tokens.alias("tokens"))


def _scanned(rows: DataFrame) -> DataFrame:
    """``rows(row)`` with ``found``: base spans, and tested tokens that overlap none of them."""
    rows = rows.withColumn("all", _found(F.coalesce("row.text", F.lit(""))))
    free = F.filter(
        F.col("all.tokens"),
        lambda t: ~F.exists(F.col("all.base"), lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    return rows.select("row", F.struct(F.col("all.base").alias("base"), free.alias("tokens")).alias("found"))


def cuts(found: DataFrame) -> dict[int, float]:
    """The p value from which on a token of a stratum is reported, from the counts of all documents.

    ``found`` has the tested tokens in ``found.tokens``. A stratum is an encoding and a length class, 63 at most.
    """
    p = F.col("t.test.p")
    counted = (
        found.select(F.explode("found.tokens").alias("t"))
        .groupBy(F.col("t.test.stratum").alias("stratum"))
        .agg(
            F.count(F.lit(1)).alias("tokens"),
            F.count(F.when(p > LEVEL, 1)).alias("upper"),
            *[F.count(F.when(p >= c, 1)).alias(f"n{i}") for i, c in enumerate(CUTS)],
        )
        .collect()
    )
    own = {row["stratum"]: (row["tokens"], row["upper"], [row[f"n{i}"] for i in range(len(CUTS))]) for row in counted}
    return stratum_cuts(own)


def stratum_cuts(counts: dict[int, tuple[int, int, list[int]]]) -> dict[int, float]:
    """The cut of every stratum from its tokens, those over LEVEL and those from every cut on; a stratum in which no
    cut holds FDR has none."""
    pools: dict[int, tuple[int, int, list[int]]] = {}
    for stratum, (tokens, upper, above) in counts.items():
        t, u, n = pools.get(stratum // 100, (0, 0, [0] * len(CUTS)))
        pools[stratum // 100] = t + tokens, u + upper, [x + y for x, y in zip(n, above)]
    out = {}
    for stratum, (tokens, upper, above) in counts.items():
        found = [_cut(upper, above)]
        if tokens < POOLED:
            found.append(_cut(*pools[stratum // 100][1:]))
        if any(c is not None for c in found):
            out[stratum] = min(c for c in found if c is not None)
    return out


def _cut(upper: int, above: list[int]) -> float | None:
    random = (upper + 1) / (1 - LEVEL)  # uniform p values
    return next((c for c, n in zip(CUTS, above) if n - random * (1 - c) <= FDR * n), None)


def _random_spans(limits: dict[int, float]) -> Column:
    """The tokens over the cut of their stratum, as spans."""
    if not limits:
        return F.array().cast("array<struct<start:int,kind:int,end:int>>")
    pairs = [F.lit(x) for s, c in limits.items() for x in (s, c)]
    limit = F.create_map(*pairs)
    kept = F.filter(F.col("found.tokens"), lambda t: F.coalesce(t["test"]["p"] >= limit[t["test"]["stratum"]], F.lit(False)))
    return F.transform(kept, lambda t: F.struct(t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end")))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) for every row.

    A span is the whole match, in code points with the end exclusive. A null text counts as empty; a text without
    secrets has the digest of the empty string and empty ``spans``. Whole texts are scanned. Repeated rows
    return a row each, other columns are ignored, an empty table gives an empty table.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stored(_scanned(packed(rows)).select("row.doc_id", "found"), "secrets")
    extra = _random_spans(cuts(found))
    base = F.col("found.base")

    def counted(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select(
        "doc_id", *map(counted, range(3)), F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat(base, extra))).alias("spans"),
        F.size(extra).cast("long").alias("n_random"),
    )


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """The documents with every secret span replaced by ``mask``; ``n_chars`` follows, if there is one.

    Overlapping spans are masked as one. All rows stay; texts without secrets, null among them, stay as they are.
    """
    limits = cuts(stored(_scanned(packed(docs.select("text"))).select("found"), "secrets"))
    spans = F.array_sort(F.concat(F.col("found.base"), _random_spans(limits)))

    def add(acc: Column, s: Column) -> Column:
        piece = F.struct(acc["at"].alias("from"), s["start"].alias("to"))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["gaps"], F.array(piece)).alias("gaps"))).otherwise(
            F.struct(F.greatest(s["end"], acc["at"]).alias("at"), acc["gaps"].alias("gaps"))
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,to:int>>").alias("gaps"))
    gaps = F.aggregate(
        F.col("spans"), start, add,
        lambda acc: F.concat(acc["gaps"], F.array(F.struct(acc["at"].alias("from"), F.char_length("row.text").alias("to")))),
    )
    masked = F.array_join(F.transform(gaps, lambda g: F.substring(F.col("row.text"), g["from"] + 1, g["to"] - g["from"])), mask)
    rows = _scanned(packed(docs)).select("row", spans.alias("spans"))
    rows = rows.select("row", F.when(F.size("spans") > 0, masked).alias("masked"))
    new = {"text": F.coalesce("masked", "row.text"), "n_chars": F.char_length("masked")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(new["n_chars"].cast(docs.schema["n_chars"].dataType), "row.n_chars")
    return rows.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])
