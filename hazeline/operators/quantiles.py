"""Exact per-group quantiles without a group's values in one task.

``percentile`` keeps a group's distinct values in one aggregation buffer, which a hot city
outgrows. Here values are counted in bins, combined before the shuffle, and the few bins
that hold a wanted rank are found from the cumulated counts. The first bins are sixteenths
of a power of two, so that they suit values of any size. A bin that holds a wanted rank and more than
``most`` values is split again between its least and its largest value, round by round,
until it is small or holds one value only; each round keeps 12 more bits of a value, so five
rounds tell any two doubles apart. Only the values of the last, small bins are ordered.

NULL and NaN are no values; groups without values have no row.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.schemas import CITY
from hazeline.session import write_and_reread

#: Most values of one group that meet in one task, unless they are equal.
MOST = 100_000
#: Bins that a bin is split into.
SPLITS = 4096
#: Bins in a table that is sent to every executor at most, about 10 MB.
BROADCAST_BINS = 100_000


def to_long(df: DataFrame, columns, keys=(CITY,)) -> DataFrame:
    """One row per key, column name and value that is neither null nor NaN."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(*keys, F.inline(F.array(*entries))).where(F.col("value").isNotNull() & ~F.isnan("value"))


def magnitude_bin(value: Column) -> Column:
    """Sixteenths of a power of two, in the order of the values."""
    octave = F.floor((F.least(F.log2(F.abs(value)), F.lit(1100.0)) + 1100) * 16) + 1
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value) * octave).cast("long")


def _counted(values: DataFrame, group, bins: Column) -> DataFrame:
    return values.groupBy(*group, bins.alias("bin")).agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )


def _below(window) -> Column:
    return F.coalesce(F.sum("n").over(window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _holding(placed: DataFrame) -> DataFrame:
    """The bins that hold wanted ranks, and those of their ranks."""
    inside = lambda w: (w["rank"] >= F.col("before")) & (w["rank"] < F.col("before") + F.col("n"))
    return placed.withColumn("wanted", F.filter("wanted", inside)).where(F.size("wanted") > 0).drop("bin")


def _within(values: DataFrame, bins: DataFrame, group) -> DataFrame:
    """Values with the bin they fall into; the bins are sent around if they are few."""
    named = bins.withColumnsRenamed({c: f"_{c}" for c in group})
    named = F.broadcast(named) if bins.count() <= BROADCAST_BINS else named
    on = F.col("value").between(F.col("low"), F.col("high"))
    for c in group:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return values.join(named, on).drop(*[f"_{c}" for c in group])


def exact_quantiles(df: DataFrame, columns, probabilities, by=(CITY,), most: int = MOST) -> DataFrame:
    """Linearly interpolated quantiles, one row per group, column and probability."""
    group = [*by, "column"]
    values = to_long(df, columns, by)
    in_group = Window.partitionBy(*group)
    exact = lambda p: F.lit(float(p)) * (F.col("total") - 1)
    ranks = [
        F.struct(F.lit(float(p)).alias("p"), (exact(p) - F.floor(exact(p))).alias("fraction"), end(exact(p)).cast("long").alias("rank"))
        for p in probabilities
        for end in (F.floor, F.ceil)
    ]
    placed = (
        _counted(values, group, magnitude_bin(F.col("value")))
        .withColumns({"before": _below(in_group), "total": F.sum("n").over(in_group)})
        .withColumn("wanted", F.array(*ranks))
        .drop("total")
    )
    bins = write_and_reread(_holding(placed), "bins")
    large = (F.col("n") > most) & (F.col("low") < F.col("high"))
    while not bins.where(large).isEmpty():
        share = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low"))
        split = F.least(F.floor(share * SPLITS), F.lit(SPLITS - 1))
        of_bin = [*group, "start"]
        inside = _within(values, bins.where(large).select(*group, "low", "high"), group)
        parts = _counted(inside.withColumn("start", F.col("low")), of_bin, split)
        outer = bins.where(large).select(*group, F.col("low").alias("start"), F.col("before").alias("_before"), "wanted")
        keys = [parts[c].eqNullSafe(outer[c]) for c in of_bin]
        placed = parts.join(outer, keys).select(*[parts[c] for c in parts.columns], "_before", "wanted")
        placed = placed.withColumn("before", F.col("_before") + _below(Window.partitionBy(*of_bin)))
        halved = _holding(placed.drop("_before")).drop("start")
        bins = write_and_reread(bins.where(~large).unionByName(halved), "bins")

    single = F.col("low") == F.col("high")
    sure = bins.where(single).select(*group, F.inline("wanted"), F.col("low").alias("value"))
    few = bins.where(~single)
    copies = _within(values, few, group).groupBy(*group, "low", "before", "wanted", "value").agg(F.count("*").alias("n"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*group, "low").orderBy("value"))
    ranked = copies.withColumn("upto", upto).select(*group, "value", "upto", "n", F.inline("wanted"))
    hit = ranked.where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
    picked = sure.unionByName(hit.select(*sure.columns))
    low, high = F.min("value"), F.max("value")
    between = F.when(low == high, low).otherwise(low + (high - low) * F.max("fraction"))  # infinities are equal, too
    return picked.groupBy(*group, "p").agg(between.alias("quantile"))


def quartiles(df: DataFrame, columns, by=(CITY,), most: int = MOST) -> DataFrame:
    """First and third quartile, long form: group, column, q1, q3."""
    found = exact_quantiles(df, columns, (0.25, 0.75), by, most)

    def at(p):
        return F.max(F.when(F.col("p") == p, F.col("quantile")))

    return found.groupBy(*by, "column").agg(at(0.25).alias("q1"), at(0.75).alias("q3"))


def iqr_bounds(df: DataFrame, columns, factor: float = 3.0, by=(CITY,)) -> DataFrame:
    """One row per group with ``<column>_low`` and ``<column>_high``."""
    spread = (F.col("q3") - F.col("q1")) * factor
    long = quartiles(df, columns, by).select(
        *by, "column", (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high")
    )
    picks = []
    for name in columns:
        mine = F.col("column") == name
        picks.append(F.max(F.when(mine, F.col("low"))).alias(f"{name}_low"))
        picks.append(F.max(F.when(mine, F.col("high"))).alias(f"{name}_high"))
    return long.groupBy(*by).agg(*picks)
