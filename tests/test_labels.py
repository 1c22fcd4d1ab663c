import pytest
from pyspark.sql import functions as F

from cytoloom.functions import labels, rules
from cytoloom.operators import consensus


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_clean_cell_type(spark):
    got = apply(
        spark,
        labels.clean_cell_type,
        ["Lung Macrophage", "Regulatory T cell", "CD8-positive, alphabeta T cell", "natural killer cell", "Mueller cell", "classical monocyte", None],
    )
    assert got[0] == "macrophage" and got[1] == "treg" and got[3] == "nk" and got[5] == "cd14_monocyte" and got[6] is None
    assert got[4] == "mueller"  # "cell" is cut before the pair rule can see it


def test_first_match_only(spark):
    assert apply(spark, lambda c: labels.replace_first(c, "a+", "x"), ["baab aa", "AA"]) == ["bxb aa", "AA"]
    assert apply(spark, lambda c: labels.replace_first(c, "(?i)a", "x"), ["AA"]) == ["xA"]
    assert apply(spark, lambda c: labels.replace_first(c, "^_+|_+$", ""), ["__a__", "a__"]) == ["a__", "a"]


def test_harmonise_later_rules_win(spark):
    got = apply(spark, labels.harmonise_non_immune, ["cardiac muscle myoblast", "serous cell", "adrenal cell", "interneuron", "B cell"])
    assert got == ["myoblast", "serous_cell", "renal_cell", "interneuron", "B_cell"]


@pytest.mark.parametrize(
    "label, days",
    [
        ("13-month-old human stage", 390), ("40-year-old human stage", 14600), ("9th week post-fertilization human stage", 63),
        ("Carnegie stage 15", None), ("Carnegie stage 23", 56), ("60-79 year-old human stage", 25367), ("under-1-year-old human stage", 182),
        ("sixth decade human stage", 19892), ("80 year-old and over human stage", 29200), ("Infant stage", 182), (" mature stage ", 14600),
        ("twelfth LMP month human stage", 360), ("twelfth decade human stage", None), ("unknown", None), ("x", None),
    ],
)
def test_age(spark, label, days):
    assert apply(spark, labels.age_in_days, [label]) == [days]


def test_strip_barcode(spark):
    got = apply(spark, labels.strip_barcode, ["123:4-5", "run1_ACGTACGTAA-1", "a::b__c", None])
    assert got == [None, "run1_1", "a_b_c", None]


def ballots(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, c string")


def test_vote_branches(spark):
    rows = [
        ("b naive", "b naive", "nk"),         # majority
        ("cd8 naive", "cd8 tcm", None),       # tie, nearest shared ancestor
        ("mast", "b naive", "b naive"),       # override beats majority
        ("cd14 mono", "macrophage", None),    # joined only for the vote
        ("cd8 tem", "nk", None),              # two ways up
        ("not a type", None, None),           # outside the hierarchy
        ("b", None, None),                    # inner type is its own ancestor
        ("mast", "nkt", None),                # first override in the given order
        ("pdc", "plasma", None),              # nothing shared
    ]
    got = consensus.vote(ballots(spark, rows), "i", ["a", "b", "c"], "label", consensus.hierarchy(spark))
    by = {r["i"]: r["label"] for r in got.collect()}
    assert [by[i] for i in range(8)] == ["b naive", "t cd8", "mast", "monocytic", "cytotoxic", None, "b", "nkt"]
    assert by[8] is None


def test_weights_decide(spark):
    df = ballots(spark, [("b naive", "nk", "pdc")])
    got = consensus.vote(df, "i", ["a", "b", "c"], "label", consensus.hierarchy(spark), weights=[1, 1, 2]).first()
    assert got["label"] == "pdc"


def test_closure_is_a_dag(spark):
    tree = consensus.closure(consensus.hierarchy(spark))
    parents = {r[0] for r in tree.where("descendant = 'tgd' AND distance = 1").select("ancestor").collect()}
    assert parents == {"t", "cytotoxic"}
    assert tree.count() == tree.select("ancestor", "descendant").distinct().count()


def test_three_source_rules(spark):
    rows = [
        ("CD4 TCM", "Th1 cells", "CD4+ Tcm", "cd4 tcm"),
        ("CD4 TEM", "Th1 cells", "CD4+ Tem", "cd4 th1 em"),
        ("CD14 Mono", "Classical monocytes", "Macrophages M1", "macrophage m1"),
        ("NK", "MAIT cells", "Fibroblasts", "non immune"),
        (None, "Naive B cells", "naive B-cells", "b naive"),
        ("NK", "not listed", "NK cells", None),
    ]
    df = spark.createDataFrame(rows, "azimuth string, monaco string, blueprint string, want string")
    for r in rules.three_source_consensus(df).collect():
        assert r["consensus"] == r["want"]
