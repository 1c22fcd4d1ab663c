"""Exact group statistics that never put a whole group into one task.

A group (one sample, one gene) may hold a third of all rows, so a plain window
over it would sort that third in a single task. The functions here first collapse
equal values and store the counts. When no group has more than SMALL_GROUP distinct
values, which is counted and not assumed, one task per group is enough. Beyond that
every group is cut into value ranges by a fixed monotone function of the value:
running totals over the ranges are small, and only the rows of one range are ever
sorted together. Both ways give the same exact numbers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoloom.session import cut_lineage

# Distinct values a single task may sort or hold for one group.
SMALL_GROUP = 500_000
# Scale that makes the median absolute deviation match a normal's sigma (fixed value).
MAD_SCALE = 1.4826


def group_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys where NULL equals NULL: a missing cell type is a group of its own."""
    if how in ("left_semi", "left_anti"):
        r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys]).distinct()
        return left.join(r, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]), how)
    r = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys], *[F.col(c) for c in right.columns if c not in keys]
    )
    cond = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def fresh(df: DataFrame) -> DataFrame:
    """The same columns under new identities, for pairing a table with a relative of itself."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by key to a fixed number of tasks, for groups with few bytes and much work.

    Adaptive execution joins partitions by their bytes, which would put many such groups into one task.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)


def value_range(value: str, per_octave: int = 256) -> Column:
    """Number of the value range of a finite number; larger values never get a smaller one."""
    v = F.col(value).cast("double")
    magnitude = F.floor(F.log2(F.abs(v)) * per_octave) + 1100 * per_octave
    return F.when(v == 0, F.lit(0).cast("long")).when(v > 0, magnitude).otherwise(-magnitude)


def value_counts(df: DataFrame, keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """One row per distinct value of a group with its number of rows ``n``."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(n.alias("n"))


def _range_totals(ranged: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("_range")
    totals = ranged.groupBy(*keys, "_range").agg(F.sum("n").alias("_range_n"))
    return totals.select(
        *keys,
        "_range",
        "_range_n",
        (F.sum("_range_n").over(w) - F.col("_range_n")).alias("_start"),
        F.sum("_range_n").over(Window.partitionBy(*keys)).alias("total"),
    )


def _stored(counts: DataFrame, keys: list[str]) -> tuple[DataFrame, bool]:
    """The counts as a stored table, and whether all their groups are small."""
    counts = cut_lineage(counts)
    largest = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size")).agg(F.max("_size")).first()[0]
    return counts, (largest or 0) <= SMALL_GROUP


def ranked_values(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Adds to ``value_counts`` the rows ``below`` a value and the ``total`` of its group."""
    counts, small = _stored(counts, keys)
    if small:
        group = Window.partitionBy(*keys)
        return counts.withColumn("below", F.sum("n").over(group.orderBy(value)) - F.col("n")).withColumn(
            "total", F.sum("n").over(group)
        )
    ranged = counts.withColumn("_range", value_range(value))
    w = Window.partitionBy(*keys, "_range").orderBy(value)
    inside = ranged.withColumn("_inside", F.sum("n").over(w) - F.col("n"))
    return (
        group_join(inside, _range_totals(ranged, keys), [*keys, "_range"])
        .withColumn("below", F.col("_start") + F.col("_inside"))
        .drop("_inside", "_start", "_range_n", "_range")
    )


def group_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], weight: str | None = None
) -> DataFrame:
    """Exact interpolated quantiles per group, one column per entry of ``probs``."""
    if not keys:
        return group_quantiles(df.withColumn("_all", F.lit(1)), ["_all"], value, probs, weight).drop("_all")
    counts, small = _stored(value_counts(df, keys, value, weight), keys)
    if small:
        q = F.percentile(F.col(value).cast("double"), F.array(*[F.lit(p) for p in probs.values()]), F.col("n"))
        return counts.groupBy(*keys).agg(q.alias("_q")).select(
            *keys, *[F.col("_q")[i].alias(name) for i, name in enumerate(probs)]
        )
    return _ranged_quantiles(counts, keys, value, probs)


def _ranged_quantiles(counts: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    ranged = counts.withColumn("_range", value_range(value))
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(p).alias("p"), F.lit(up).alias("up"))
            for name, p in probs.items()
            for up in (False, True)
        ]
    )
    at = F.col("_w.p") * (F.col("total") - 1)
    targets = (
        _range_totals(ranged, keys)
        .withColumn("_w", F.explode(wanted))
        .withColumn("_at", F.when(F.col("_w.up"), F.ceil(at)).otherwise(F.floor(at)))
        .withColumn("_share", at - F.floor(at))
        .where((F.col("_at") >= F.col("_start")) & (F.col("_at") < F.col("_start") + F.col("_range_n")))
        .select(*keys, "_range", "_start", "_at", "_share", "_w")
    )
    w = Window.partitionBy(*keys, "_range").orderBy(value)
    inside = (
        group_join(ranged, targets, [*keys, "_range"], "left_semi")
        .withColumn("_upto", F.sum("n").over(w))
        .withColumn("_from", F.col("_upto") - F.col("n"))
    )
    hit = group_join(inside, targets, [*keys, "_range"]).where(
        (F.col("_at") - F.col("_start") >= F.col("_from")) & (F.col("_at") - F.col("_start") < F.col("_upto"))
    )
    v = F.col(value).cast("double")

    def pick(name: str, up: bool) -> Column:
        return F.max(F.when((F.col("_w.name") == name) & (F.col("_w.up") == F.lit(up)), v))

    return hit.groupBy(*keys).agg(
        *[
            (
                pick(n, False)
                + (pick(n, True) - pick(n, False)) * F.max(F.when(F.col("_w.name") == n, F.col("_share")))
            ).alias(n)
            for n in probs
        ]
    )


def mad_limits(df: DataFrame, keys: list[str], metrics: list[str], nmads: float = 3.0) -> DataFrame:
    """median + nmads * scaled MAD per group, one column ``<metric>_limit`` per metric.

    All metrics go through the two quantile passes together.
    """
    by = [*keys, "_metric"]
    long = df.select(
        *keys, F.inline(F.array(*[F.struct(F.lit(m).alias("_metric"), F.col(m).cast("double").alias("_x")) for m in metrics]))
    )
    med = group_quantiles(long, by, "_x", {"_median": 0.5})
    dev = group_join(long, med, by).withColumn("_dev", F.abs(F.col("_x") - F.col("_median")))
    mad = group_quantiles(dev, by, "_dev", {"_mad": 0.5})
    limit = F.col("_median") + nmads * MAD_SCALE * F.col("_mad")
    return (
        group_join(med, mad, by)
        .groupBy(*keys)
        .agg(*[F.max(F.when(F.col("_metric") == m, limit)).alias(f"{m}_limit") for m in metrics])
    )


def mad_outliers(df: DataFrame, keys: list[str], flags: dict[str, str], nmads: float = 3.0) -> DataFrame:
    """Adds, per metric -> flag, the metric's limit and whether the value lies above it."""
    out = group_join(df, mad_limits(df, keys, list(flags), nmads), keys, "left")
    for metric, flag in flags.items():
        out = out.withColumn(flag, F.col(metric) > F.col(f"{metric}_limit"))
    return out


def benjamini_hochberg(df: DataFrame, keys: list[str], p: str, out: str) -> DataFrame:
    """False discovery rate of every p value inside its group."""
    if not keys:
        return benjamini_hochberg(df.withColumn("_all", F.lit(1)), ["_all"], p, out).drop("_all")
    counts, small = _stored(value_counts(df, keys, p), keys)
    ranked = ranked_values(counts, keys, p).withColumn("_q", F.col(p) * F.col("total") / (F.col("below") + F.col("n")))
    if small:
        larger = Window.partitionBy(*keys).orderBy(F.desc(p))
        adjusted = ranked.withColumn(out, F.least(F.lit(1.0), F.min("_q").over(larger)))
    else:
        ranked = ranked.withColumn("_range", value_range(p))
        best = ranked.groupBy(*keys, "_range").agg(F.min("_q").alias("_range_best"))
        later = Window.partitionBy(*keys).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
        best = best.withColumn("_later_best", F.min("_range_best").over(later)).drop("_range_best")
        inside = Window.partitionBy(*keys, "_range").orderBy(F.desc(p))
        adjusted = group_join(ranked.withColumn("_q", F.min("_q").over(inside)), best, [*keys, "_range"]).withColumn(
            out, F.least(F.lit(1.0), F.col("_q"), F.col("_later_best"))
        )
    return group_join(df, adjusted.select(*keys, p, out), [*keys, p], "left")


def hash_order(*columns: str, seed: int = 42) -> Column:
    """Reproducible pseudo-random order of rows; replaces a random generator."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def first_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int | Column, salts: int = 64) -> DataFrame:
    """The first k rows of every group, whatever k and the size of the group.

    Salted parts keep their first k rows; what is left is numbered over range partitions, so no task
    holds a group.
    """
    limit = F.lit(k) if isinstance(k, int) else k
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if _hashable(df, c)]), F.lit(salts))
    part = Window.partitionBy(*keys, "_salt").orderBy(*order)
    few = df.withColumn("_salt", salt).withColumn("_place", F.row_number().over(part)).where(F.col("_place") <= limit)
    few = few.drop("_salt", "_place")
    names = [f"_order{i}" for i in range(len(order))]
    numbered = dense_index(few.withColumns(dict(zip(names, order))), keys, names, "_place")
    return numbered.where(F.col("_place") <= limit).drop("_place", *names)


def _hashable(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() not in ("map", "variant")


def dense_index(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """1, 2, 3 … inside each group in the given order, for groups of any size.

    The rows are range-partitioned and sorted once and stored; a group that spans
    many partitions gets its start in each of them from the partition's row counts.
    """
    placed = (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    placed = cut_lineage(placed).withColumn("_part", F.shiftright("_pos", 33))
    spans = placed.groupBy(*keys, "_part").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = F.coalesce(
        F.sum("_rows").over(
            Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    spans = spans.withColumn("_before", before).drop("_rows")
    return (
        group_join(placed, spans, [*keys, "_part"])
        .withColumn(out, F.col("_before") + F.col("_pos") - F.col("_first") + 1)
        .drop("_pos", "_part", "_first", "_before")
    )


def log_factorial(n: Column) -> Column:
    """ln(n!) for n >= 0 by Stirling's series after shifting the argument up by eight."""
    z = n + 9.0
    series = (
        (z - 0.5) * F.log(z)
        - z
        + 0.9189385332046727
        + 1.0 / (12.0 * z)
        - 1.0 / (360.0 * z * z * z)
        + 1.0 / (1260.0 * F.pow(z, F.lit(5.0)))
        - 1.0 / (1680.0 * F.pow(z, F.lit(7.0)))
        + 1.0 / (1188.0 * F.pow(z, F.lit(9.0)))
    )
    shift = reduce(Column.__add__, [F.log(n + float(i)) for i in range(1, 9)])
    return series - shift
