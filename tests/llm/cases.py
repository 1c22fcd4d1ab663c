"""Awkward documents every operator must survive: nulls, empty and long texts, ties, repeated rows, clashing names."""

ODD_TEXTS = [
    None, "", " ", "\n\t", "a", "two words", "a b c d", "a b c d", "ünïcode Ünïcode ▁ ▁▁ mark", "😀 astral 😀😀",
    "x" * 5000, "word " * 30_000, "The quick brown fox jumps over the lazy dog again and again today",
    "the QUICK brown fox jumps over the lazy dog again and again today", "tab\tsep\x0bvt\x0cff\rcr\nlf nbsp end \x1c fs",
    "\\### Assistant: </turn> ok", "日本語 テキスト", "\x00nul", "12345 67890",
]


def odd_docs(spark, extra="score double, held_out string, fingerprint string, node long, `__id` long, shingle long, tokens long"):
    """Rows with a null id, a repeated row, a shared id, and extra columns with names the operators use."""
    rows = [(i * 10, t, "en" if i % 3 else None, f"src{i % 2}" if i else None, len(t or "")) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "a b c d", None, None, None), (None, None, None, None, None), rows[12], (120, "other text with the same id as another row", "de", "src1", 1)]
    pad = (None,) * len(extra.split(","))
    return spark.createDataFrame(
        [r + pad for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
    )


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
