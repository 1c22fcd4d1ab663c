"""Cleaning of free-text labels: cell types, ages, barcodes, tissues.

The word lists and patterns below are fixed values: results are only right when
they hold exactly these, in this order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cleaning steps of cell-type names, applied in this order.
# "first" rewrites the first match, "all" every match, "trim" cuts blanks at both ends.
CELL_TYPE_STEPS = [
    ("all", ",", ""),
    ("first", "alphabeta", ""),
    ("all", "positive", ""),
    ("first", "cd4  t", "cd4"),
    ("first", "regulatory t", "treg"),
    ("first", "thymusderived", ""),
    ("first", "human", ""),
    ("first", "igg ", ""),
    ("first", "igm ", ""),
    ("first", "iga ", ""),
    ("first", "group [0-9]", ""),
    ("first", "common", ""),
    ("first", "cd45ro", ""),
    ("first", "type i", ""),
    ("first", "germinal center", ""),
    ("first", "iggnegative", ""),
    ("first", "terminally differentiated", ""),
    ("first", ".*macrophage.*", "macrophage"),
    ("first", "^mononuclear phagocyte$", "macrophage"),
    ("first", ".* treg.*", "treg"),
    ("first", ".* dendritic.*", "dendritic"),
    ("first", ".* thelper.*", "thelper"),
    ("first", ".*thelper .*", "thelper"),
    ("first", ".*gammadelta.*", "tgd"),
    ("first", ".*natural killer.*", "nk"),
    ("all", "  ", " "),
    ("first", "myeloid leukocyte", "myeloid"),
    ("first", "effector memory", "tem"),
    ("first", "effector", "tem"),
    ("all", "cd8 t", "cd8"),
    ("first", "central memory", "tcm"),
    ("first", "gammadelta t", "gdt"),
    ("first", "nonclassical monocyte", "cd16 monocyte"),
    ("first", "classical monocyte", "cd14 monocyte"),
    ("first", "follicular b", "b"),
    ("first", "unswitched memory", "memory"),
    ("trim", "", ""),
    ("all", "\\+", ""),
    ("all", "cells", ""),
    ("all", "cell", ""),
    ("all", "blast", ""),
    ("all", "-", ""),
    ("trim", "", ""),
    ("first", "^_+|_+$", ""),
    ("first", "(?i)\\bepithelial\\b", "epithelial_cell"),
    ("first", "(?i)\\bfibroblast\\b", "fibroblast"),
    ("first", "(?i)\\bendothelial\\b", "endothelial_cell"),
    ("first", "(?i)^(Mueller cell|Muller cell)$", "Muller_cell"),
    ("first", "(?i)\\bneuron\\b", "neuron"),
    ("first", "(?i)amplifying cell", "amplifying_cell"),
    ("first", "(?i)stem cell", "stem_cell"),
    ("first", "(?i)progenitor cell", "progenitor_cell"),
    ("first", "(?i)acinar cell", "acinar_cell"),
    ("first", "(?i)goblet cell", "goblet_cell"),
    ("first", "(?i)thymocyte", "thymocyte"),
    ("first", "(?i)urothelial", "urothelial_cell"),
    ("first", "(?i)\\bfat\\b", "fat_cell"),
    ("first", "(?i)pneumocyte", "pneumocyte"),
    ("first", "(?i)mesothelial", "mesothelial_cell"),
    ("first", "(?i)enteroendocrine", "enteroendocrine_cell"),
    ("first", "(?i)enterocyte", "enterocyte"),
    ("first", "(?i)\\bbasal\\b", "basal_cell"),
    ("first", "(?i)stromal", "stromal_cell"),
    ("first", "(?i)retina", "retinal_cell"),
    ("first", "(?i)ciliated", "ciliated_cell"),
    ("first", "(?i)pericyte", "pericyte_cell"),
    ("first", "(?i)trophoblast", "trophoblast"),
    ("first", "(?i)brush", "brush_cell"),
    ("first", "(?i)serous", "serous_cell"),
    ("first", "(?i)hepatocyte", "hepatocyte"),
    ("first", "(?i)melanocyte", "melanocyte"),
    ("first", "(?i)myocyte", "myocyte"),
    ("first", "(?i)promyelocyte", "promyelocyte"),
    ("first", "(?i)cholangiocyte", "cholangiocyte"),
    ("first", "(?i)myoblast", "myoblast"),
    ("first", "(?i)satellite", "satellite_cell"),
    ("first", "(?i)muscle", "muscle_cell"),
    ("first", "(?i)progenitor", "progenitor_cell"),
    ("first", "(?i)erythrocyte", "erythrocyte"),
    ("first", "(?i)myoepithelial", "myoepithelial_cell"),
    ("first", "(?i)myofibroblast", "myofibroblast_cell"),
    ("first", "(?i)pancreatic", "pancreatic_cell"),
    ("first", "(?i)renal", "renal_cell"),
    ("first", "(?i)epidermal", "epidermal_cell"),
    ("first", "(?i)cortical", "cortical_cell"),
    ("first", "(?i)interstitial", "interstitial_cell"),
    ("first", "(?i)neuroendocrine", "neuroendocrine_cell"),
    ("first", "(?i)granular", "granular_cell"),
    ("first", "(?i)kidney", "kidney_cell"),
    ("first", "(?i)paneth", "paneth_cell"),
    ("first", "(?i)bipolar", "bipolar_cell"),
    ("all", " ", "_"),
]

# A name that matches becomes the value, in this order; later rules see
# what earlier rules wrote.
NON_IMMUNE_RULES = [
    ("(?i)\\bepithelial\\b", "epithelial_cell"),
    ("(?i)\\bfibroblast\\b", "fibroblast"),
    ("(?i)\\bendothelial\\b", "endothelial_cell"),
    ("^(Mueller cell|Muller cell)$", "Muller_cell"),
    ("(?i)\\bneuron\\b", "neuron"),
    ("(?i)amplifying cell", "amplifying_cell"),
    ("(?i)stem cell", "stem_cell"),
    ("(?i)progenitor cell", "progenitor_cell"),
    ("(?i)acinar cell", "acinar_cell"),
    ("(?i)goblet cell", "goblet_cell"),
    ("(?i)thymocyte", "thymocyte"),
    ("(?i)urothelial", "urothelial_cell"),
    ("(?i)fat", "fat_cell"),
    ("(?i)pneumocyte", "pneumocyte"),
    ("(?i)mesothelial", "mesothelial_cell"),
    ("(?i)enteroendocrine", "enteroendocrine_cell"),
    ("(?i)enterocyte", "enterocyte"),
    ("(?i)basal", "basal_cell"),
    ("(?i)stromal", "stromal_cell"),
    ("(?i)retina", "retinal_cell"),
    ("(?i)ciliated", "ciliated_cell"),
    ("(?i)pericyte", "pericyte_cell"),
    ("(?i)trophoblast", "trophoblast"),
    ("(?i)brush", "brush_cell"),
    ("(?i)serous", "serous cell"),
    ("(?i)hepatocyte", "hepatocyte"),
    ("(?i)melanocyte", "melanocyte"),
    ("(?i)myocyte", "myocyte"),
    ("(?i)promyelocyte", "promyelocyte"),
    ("(?i)cholangiocyte", "cholangiocyte"),
    ("(?i)myoblast", "myoblast"),
    ("(?i)satellite", "satellite_cell"),
    ("(?i)muscle", "muscle_cell"),
    ("(?i)progenitor", "progenitor_cell"),
    ("(?i)erythrocyte", "erythrocyte"),
    ("(?i)myoepithelial", "myoepithelial_cell"),
    ("(?i)myofibroblast", "myofibroblast_cell"),
    ("(?i)pancreatic", "pancreatic_cell"),
    ("(?i)renal", "renal_cell"),
    ("(?i)epidermal", "epidermal_cell"),
    ("(?i)cortical", "cortical_cell"),
    ("(?i)interstitial", "interstitial_cell"),
    ("(?i)neuroendocrine", "neuroendocrine_cell"),
    ("(?i)granular", "granular_cell"),
    ("(?i)kidney", "kidney_cell"),
    ("(?i)paneth", "paneth_cell"),
    ("(?i)bipolar", "bipolar_cell"),
]

# Days of the Carnegie stages.
CARNEGIE_DAYS = {
    "9": 20, "10": 22, "11": 24, "12": 26, "13": 28, "14": 32, "16": 37,
    "17": 41, "18": 44, "19": 46, "20": 49, "21": 51, "22": 53, "23": 56,
}
# Ordinal words.
ORDINALS = [
    "first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth",
    "eleventh", "twelfth", "thirteenth", "fourteenth", "fifteenth", "sixteenth", "seventeenth",
    "eighteenth", "nineteenth", "twentieth", "twenty-first", "twenty-second", "twenty-third",
]
# Days of the named stages.
STAGE_DAYS = {
    "newborn human": 0.0,
    "infant": 182.5,
    "child": 2190.0,
    "adolescent": 5475.0,
    "young adult": 9125.0,
    "human early adulthood": 9125.0,
    "human middle aged": 18250.0,
    "human late adulthood": 25550.0,
    "human adult": 14600.0,
    "human aged": 27375.0,
    "mature": 14600.0,
    "immature": 365.0,
    "embryonic human": 28.0,
    "organogenesis": 28.0,
}
DAYS_PER = {"month": 30, "year": 365, "week": 7}


def replace_first(text: Column, pattern: str, replacement: str) -> Column:
    """Spark rewrites every match; a lazy prefix anchored at the start leaves just the first."""
    flags = ""
    while pattern.startswith("(?i)"):
        flags, pattern = "(?i)", pattern[4:]
    return F.regexp_replace(text, f"(?s){flags}^(.*?)(?:{pattern})", f"$1{replacement}")


def clean_cell_type(name: Column) -> Column:
    out = F.lower(name)
    for kind, pattern, replacement in CELL_TYPE_STEPS:
        if kind == "first":
            out = replace_first(out, pattern, replacement)
        elif kind == "all":
            out = F.regexp_replace(out, pattern, replacement)
        else:
            out = F.regexp_replace(out, "^\\s+|\\s+$", "")
    return out


def harmonise_non_immune(name: Column) -> Column:
    """Later rules see earlier rewrites, so the rules run as one fold over a rule array."""
    rules = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(v).alias("v")) for p, v in NON_IMMUNE_RULES])
    folded = F.aggregate(rules, name, lambda acc, r: F.when(F.rlike(acc, r["p"]), r["v"]).otherwise(acc))
    return F.regexp_replace(folded, " ", "_")


def on_distinct(df: DataFrame, column: str, out: str, fn) -> DataFrame:
    """Apply a costly text function once per distinct label and join the result back."""
    labels = df.select(column).where(F.col(column).isNotNull()).distinct()
    return df.join(labels.withColumn(out, fn(F.col(column))), column, "left")


def _lookup(values: dict, key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[key]


def age_in_days(label: Column) -> Column:
    """Age label to whole days; the first pattern that matches decides, the rest is NULL."""
    t = F.regexp_replace(label, "^[ \\t\\r\\n]+|[ \\t\\r\\n]+$", "")

    def number(pattern: str, group: int = 1) -> Column:
        return F.regexp_extract(t, pattern, group).try_cast("double")

    month = "^(\\d+)-month-old human stage$"
    year = "^(\\d+)-year-old human stage$"
    week = "^(\\d+)(?:st|nd|rd|th) week post-fertilization human stage$"
    carnegie = "^Carnegie stage (\\d+)$"
    years = "^(\\d+)-(\\d+) year-old human stage$"
    child = "^(\\d+)-(\\d+) year-old child stage$"
    lmp = "^(\\w+) LMP month human stage$"
    decade = "^(\\w+) decade human stage$"
    over = "^(\\d+).*year-old and over human stage$"
    stage = "^(.*) stage$"
    ordinal = {w: float(i + 1) for i, w in enumerate(ORDINALS)}
    tens = {w: 10.0 * i + 4.5 for i, w in enumerate(ORDINALS[:10])}
    days = (
        F.when(F.lower(t) == "unknown", F.lit(None).cast("double"))
        .when(t.rlike(month), number(month) * DAYS_PER["month"])
        .when(t.rlike(year), number(year) * DAYS_PER["year"])
        .when(t.rlike(week), number(week) * DAYS_PER["week"])
        .when(
            t.rlike(carnegie),
            _lookup({k: float(v) for k, v in CARNEGIE_DAYS.items()}, F.regexp_extract(t, carnegie, 1)),
        )
        .when(t.rlike(years), (number(years) + number(years, 2)) / 2 * DAYS_PER["year"])
        .when(t.rlike(child), (number(child) + number(child, 2)) / 2 * DAYS_PER["year"])
        .when(t == "under-1-year-old human stage", F.lit(0.5 * DAYS_PER["year"]))
        .when(t.rlike(lmp), _lookup(ordinal, F.lower(F.regexp_extract(t, lmp, 1))) * DAYS_PER["month"])
        .when(t.rlike(decade), _lookup(tens, F.lower(F.regexp_extract(t, decade, 1))) * DAYS_PER["year"])
        .when(t.rlike(over), number(over) * DAYS_PER["year"])
        .when(t.rlike(stage), _lookup(STAGE_DAYS, F.lower(F.regexp_extract(t, stage, 1))))
    )
    return days.cast("int")


def strip_barcode(cell: Column) -> Column:
    """Drop ids made of digits and separators, long ACGT runs and doubled separators."""
    cleaned = F.regexp_replace(F.regexp_replace(cell, "[ACGT]{5,}", ""), "[:_-]{2,}", "_")
    return F.when(~cell.rlike("^[0-9:_\\-*]+$"), cleaned)


def without_spaces(text: Column) -> Column:
    return F.regexp_replace(text, " ", "")


def paste(*columns: Column, sep: str = "_") -> Column:
    """Concatenation in which a missing part reads NA."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("NA")) for c in columns])


def tissue_group(df: DataFrame, groups: DataFrame, column: str = "tissue") -> DataFrame:
    """Attach the group of a tissue; the tissue list (tissue, tissue_group) is an input table."""
    return df.join(groups.select(F.col("tissue").alias(column), "tissue_group").distinct(), column, "left")
