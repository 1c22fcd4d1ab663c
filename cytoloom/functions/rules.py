"""Agreement of three annotation sources: dictionaries, label families and ordered rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoloom.functions.stats import group_join

# Label of each source -> label of the shared grid.
MONACO = {
    "naive cd8 t cells": "cd8 naive",
    "central memory cd8 t cells": "cd8 tcm",
    "effector memory cd8 t cells": "cd8 tem",
    "terminal effector cd8 t cells": "cd8 tem",
    "mait cells": "mait",
    "vd2 gd t cells": "tgd",
    "non-vd2 gd t cells": "tgd",
    "follicular helper t cells": "cd4 fh",
    "t regulatory cells": "treg",
    "th1 cells": "cd4 th1",
    "th1/th17 cells": "cd4 th1/th17",
    "th17 cells": "cd4 th17",
    "th2 cells": "cd4 th2",
    "naive cd4 t cells": "cd4 naive",
    "progenitor cells": "progenitor",
    "naive b cells": "b naive",
    "naive b": "b naive",
    "non-switched memory b cells": "b memory",
    "nonswitched memory b": "b memory",
    "exhausted b cells": "plasma",
    "switched memory b cells": "b memory",
    "switched memory b": "b memory",
    "plasmablasts": "plasma",
    "classical monocytes": "cd14 mono",
    "intermediate monocytes": "cd14 mono",
    "non classical monocytes": "cd16 mono",
    "natural killer cells": "nk",
    "natural killer": "nk",
    "plasmacytoid dendritic cells": "pdc",
    "myeloid dendritic cells": "cdc",
    "myeloid dendritic": "cdc",
    "low-density neutrophils": "granulocyte",
    "lowdensity neutrophils": "granulocyte",
    "low-density basophils": "granulocyte",
    "lowdensity basophils": "granulocyte",
    "terminal effector cd4 t cells": "cd4 tem",
    "progenitor": "progenitor",
}
AZIMUTH = {
    "nk": "nk",
    "cd8 tem": "cd8 tem",
    "cd4 ctl": "cd4 helper",
    "dnt": "dnt",
    "cd8 naive": "cd8 naive",
    "cd4 naive": "cd4 naive",
    "cd4 tcm": "cd4 tcm",
    "gdt": "tgd",
    "cd8 tcm": "cd8 tcm",
    "mait": "mait",
    "cd4 tem": "cd4 tem",
    "ilc": "ilc",
    "cd14 mono": "cd14 mono",
    "cdc1": "cdc",
    "pdc": "pdc",
    "cdc2": "cdc",
    "b naive": "b naive",
    "b intermediate": "b memory",
    "b memory": "b memory",
    "platelet": "platelet",
    "eryth": "erythrocyte",
    "cd16 mono": "cd16 mono",
    "hspc": "progenitor",
    "treg": "treg",
    "nk_cd56bright": "nk",
    "plasmablast": "plasma",
    "nk proliferating": "nk",
    "asdc": "cdc",
    "cd8 proliferating": "cd8 tem",
    "cd4 proliferating": "cd4 tem",
    "doublet": "non immune",
}
BLUEPRINT = {
    "neutrophils": "granulocyte",
    "monocytes": "monocyte",
    "mep": "progenitor",
    "cd4+ t-cells": "cd4 t",
    "tregs": "treg",
    "cd4+ tcm": "cd4 tcm",
    "cd4+ tem": "cd4 tem",
    "cd8+ tcm": "cd8 tcm",
    "cd8+ tem": "cd8 tem",
    "nk cells": "nk",
    "naive b-cells": "b naive",
    "memory b-cells": "b memory",
    "class-switched memory b-cells": "b memory",
    "hsc": "progenitor",
    "mpp": "progenitor",
    "clp": "progenitor",
    "gmp": "progenitor",
    "macrophages": "macrophage",
    "cd8+ t-cells": "cd8",
    "cd8 t": "cd8",
    "erythrocytes": "erythrocyte",
    "megakaryocytes": "megakaryocytes",
    "cmp": "progenitor",
    "macrophages m1": "macrophage m1",
    "macrophages m2": "macrophage m2",
    "endothelial cells": "endothelial",
    "dc": "cdc",
    "eosinophils": "granulocyte",
    "plasma cells": "plasma",
    "chondrocytes": "chondrocyte",
    "fibroblasts": "fibroblast",
    "smooth muscle": "smooth muscle",
    "epithelial cells": "epithelial",
    "melanocytes": "melanocyte",
    "skeletal muscle": "muscle",
    "keratinocytes": "keratinocyte",
    "mv endothelial cells": "endothelial",
    "myocytes": "myocyte",
    "adipocytes": "fat",
    "neurons": "neuron",
    "pericytes": "pericyte",
    "preadipocytes": "adipocyte",
    "astrocytes": "astrocyte",
    "mesangial cells": "mesangial",
}

# Label families.
FAMILIES = {
    "non immune": [
        "megakaryocytes", "endothelial", "chondrocyte", "fibroblast", "smooth muscle", "epithelial", "melanocyte",
        "muscle", "keratinocyte", "myocyte", "fat", "neuron", "pericyte", "adipocyte", "astrocyte", "mesangial",
    ],
    "t": [
        "cd8 naive", "cd8 tcm", "cd8 tem", "cd4 tem", "cd4 tcm", "cd4 effector", "treg", "cd4 th1/th17", "cd4 th1",
        "cd4 th17", "cd4 th2", "cd4 t", "t_nk", "cd8 effector", "dnt", "cd4 naive", "tgd", "cd4 fh", "mait",
    ],
    "b": ["b naive", "b memory", "plasma"],
    "myeloid": [
        "cd14 mono", "monocyte", "cd16 mono", "macrophage", "macrophage m1", "macrophage m2", "macrophages", "cdc",
        "kupffer",
    ],
    "ilc": ["ilc", "nk"],
    "helper": ["cd4 fh", "cd4 th1", "cd4 th1/th17", "cd4 th17", "cd4 th2"],
    "tcm": ["cd4 tcm"],
    "tem": ["cd4 tem"],
}
PATTERNS = {
    "like cd8": "cd8",
    "like cd4": "cd4|treg",
    "like mono": " mono",
    "like monocyte": "monocyte",
    "like macrophage": "macrophage",
}
# A label counts as cytotoxic when it is an innate lymphoid cell or a CD8 cell.
UNIONS = {"cytotoxic": ["ilc", "like cd8"]}


def _pairs(family: str, label: str) -> list[tuple]:
    return [(family, family, None, label), (family, None, family, label), (None, family, family, label)]


# Rules in order, each a family for (blueprint, monaco, azimuth) and the label.
# "same" in two or three places asks for equal labels; "=x" takes the label of source x.
RULES = [
    ("non immune", None, None, "non immune"),
    ("same", "same", "same", "=blueprint"),
    ("tcm", "helper", "tcm", "cd4 tcm"),
    ("tem", "helper", "tem", "=monaco em"),
    ("like macrophage", "like mono", "like mono", "=blueprint"),
    ("same", "same", None, "=blueprint"),
    ("same", None, "same", "=blueprint"),
    (None, "same", "same", "=monaco"),
    ("like cd8", "like cd8", "like cd8", "t cd8"),
    ("like cd4", "like cd4", "like cd4", "t cd4"),
    ("t", "t", "t", "t"),
    ("b", "b", "b", "b"),
    ("myeloid", "myeloid", "myeloid", "monocytic"),
    ("ilc", "ilc", "ilc", "ilc"),
    ("cytotoxic", "cytotoxic", "cytotoxic", "cytotoxic"),
    *_pairs("like cd8", "t cd8"),
    ("tcm", "helper", None, "cd4 tcm"),
    (None, "helper", "tcm", "cd4 tcm"),
    ("tem", "helper", None, "=monaco em"),
    (None, "helper", "tem", "=monaco em"),
    *_pairs("like cd4", "t cd4"),
    *_pairs("t", "t"),
    *_pairs("b", "b"),
    ("like monocyte", "like mono", None, "=monaco"),
    ("like monocyte", None, "like mono", "=azimuth"),
    ("like macrophage", "like mono", None, "=blueprint"),
    ("like macrophage", None, "like mono", "=blueprint"),
    *_pairs("myeloid", "monocytic"),
    *_pairs("ilc", "ilc"),
    *_pairs("cytotoxic", "cytotoxic"),
]

# Label pairs of (azimuth, blueprint) that support each other without being equal.
STRONG_PAIRS = [
    ("cd14 mono", "monocytes"),
    ("b naive", "naive b"),
    ("cd16 mono", "monocytes"),
    ("plasma", "plasma"),
    ("b memory", "class-switched memory b"),
    ("nk_cd56bright", "nk"),
    ("treg", "tregs"),
    ("b memory", "memory b"),
    ("nk proliferating", "nk"),
    ("cd8 tem", "cd8 t"),
    ("cdc2", "dc"),
    ("cd4 naive", "cd4 t"),
    ("cd4 tcm", "cd4 t"),
    ("cd8 tcm", "cd8 t"),
    ("cd4 tem", "cd4 t"),
    ("sdc", "dc"),
    ("mait", "cd8 t"),
]


def strong_evidence(azimuth: Column, blueprint: Column) -> Column:
    listed = reduce(Column.__or__, [(azimuth == a) & (blueprint == b) for a, b in STRONG_PAIRS])
    return F.coalesce((azimuth == blueprint) | listed, F.lit(False))


def dictionary_value(label: Column, dictionary: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in dictionary.items() for x in kv])[F.lower(label)]


def belongs(label: Column, family: str) -> Column:
    if family in UNIONS:
        return reduce(Column.__or__, [belongs(label, f) for f in UNIONS[family]])
    return label.rlike(PATTERNS[family]) if family in PATTERNS else label.isin(FAMILIES[family])


def agreed_label(blueprint: Column, monaco: Column, azimuth: Column) -> Column:
    """First rule that holds; NULL without one, or when blueprint or monaco is unknown."""
    sources = {"blueprint": blueprint, "monaco": monaco, "azimuth": azimuth}
    out = None
    for *families, label in RULES:
        tests, equal = [], []
        for column, family in zip(sources.values(), families):
            if family == "same":
                equal.append(column)
            elif family is not None:
                tests.append(belongs(column, family))
        tests += [equal[0] == other for other in equal[1:]]
        if label.startswith("="):
            name, _, suffix = label[1:].partition(" ")
            value = F.concat(sources[name], F.lit(f" {suffix}")) if suffix else sources[name]
        else:
            value = F.lit(label)
        test = reduce(Column.__and__, tests)
        out = F.when(test, value) if out is None else out.when(test, value)
    return F.when(blueprint.isNotNull() & monaco.isNotNull(), out)


def three_source_consensus(
    annotations: DataFrame, azimuth: str = "azimuth", monaco: str = "monaco", blueprint: str = "blueprint"
) -> DataFrame:
    """Adds ``consensus``; the rules run once per distinct triple of labels."""
    triple = [azimuth, monaco, blueprint]
    grid = (
        annotations.select(*triple)
        .distinct()
        .withColumn("_a", dictionary_value(F.col(azimuth), AZIMUTH))
        .withColumn("_m", dictionary_value(F.col(monaco), MONACO))
        .withColumn("_b", dictionary_value(F.col(blueprint), BLUEPRINT))
        .withColumn("consensus", agreed_label(F.col("_b"), F.col("_m"), F.col("_a")))
        .drop("_a", "_m", "_b")
    )
    return group_join(annotations, grid, triple, "left")


# Reference whose labels serve a kind of tissue.
TISSUE_REFERENCE = {"pbmc": "monaco", "solid": "blueprint", "atypical": None, "none": "monaco"}


def label_source(tissue: Column, detail: str) -> Column:
    """Name of the label column (detail: fine or coarse) for a kind of tissue."""
    out = F.lit(None).cast("string")
    for kind, reference in reversed(TISSUE_REFERENCE.items()):
        out = F.when(tissue == kind, F.lit(f"{reference}_first_labels_{detail}" if reference else "none")).otherwise(out)
    return out
