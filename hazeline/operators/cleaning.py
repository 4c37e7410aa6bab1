"""Gap filling, outlier capping and edge filling of series."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline import series
from hazeline.operators.projection import drop_incomplete
from hazeline.operators.quantiles import iqr_bounds
from hazeline.schemas import MEASURES, POLLUTANTS, TIME
from hazeline.series import BLOCK, DEFAULT, INDEX, POS, ROWS, Layout
from hazeline.session import write_and_reread


def parse_times(df: DataFrame, time: str = TIME) -> DataFrame:
    """Time column as a timestamp; text that is no time becomes NULL."""
    parsed = F.try_to_timestamp(time) if dict(df.dtypes)[time] == "string" else F.col(time).cast("timestamp")
    return df.withColumn(time, parsed)


def nan_to_null(df: DataFrame, columns=MEASURES) -> DataFrame:
    """The source format may hold NaN for missing numbers."""
    floats = [n for n, t in df.dtypes if n in columns and t in ("double", "float")]
    return df.withColumns({n: F.when(~F.isnan(n), F.col(n)) for n in floats})


def missing_counts(df: DataFrame, columns=MEASURES, by=("city",)) -> DataFrame:
    return df.groupBy(*by).agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in columns])


def interpolate_time(df: DataFrame, columns=MEASURES, limit: int = 3, layout: Layout = DEFAULT) -> DataFrame:
    """Fill gaps linearly in time, at most ``limit`` rows into each gap.

    A row is filled when a known value lies within ``limit`` rows before it; the
    next known value may be any distance away. Without a next one the last value
    is held. The series is written once, in time slices; known values beyond a slice
    come from one small row per slice, for both directions. Returns the series
    positioned, its slices as blocks.
    """
    indexed = series.index_chunks(df, layout, "gaps")
    clock = F.unix_micros(F.col(layout.time).cast("timestamp"))
    value = {c: F.col(c).cast("double") for c in columns}
    # Plain numbers, not structs, so that the aggregation can hash and combine.
    parts = {f"t_{c}": F.when(v.isNotNull(), clock) for c, v in value.items()}
    parts |= {f"v_{c}": v for c, v in value.items()}
    parts |= {f"p_{c}": F.when(v.isNotNull(), F.col(INDEX).cast("long")) for c, v in value.items()}
    blocks = series.block_offsets(indexed, layout, series.known_summaries(parts, INDEX))
    blocks = blocks.withColumns({f"_last_p_{c}": F.col("_before") + F.col(f"_last_p_{c}") - 1 for c in columns})
    beyond = series.carried(blocks, parts, layout)
    beyond = blocks.select(layout.key, BLOCK, "_before", ROWS, *[e.alias(n) for n, e in beyond.items()])
    rows = indexed.join(beyond, [layout.key, BLOCK]).withColumn(POS, F.col("_before") + F.col(INDEX) - 1)

    upto = series.block_window(layout).rowsBetween(Window.unboundedPreceding, 0)
    onward = series.block_window_reversed(layout).rowsBetween(Window.unboundedPreceding, 0)
    point = lambda c: F.when(value[c].isNotNull(), F.struct(clock.alias("t"), value[c].alias("v"), F.col(POS).alias("p")))
    marked = rows.select("*", *[F.last(point(c), ignorenulls=True).over(upto).alias(f"_prev_{c}") for c in columns])
    marked = marked.select("*", *[F.last(point(c), ignorenulls=True).over(onward).alias(f"_next_{c}") for c in columns])

    def filled(c):
        before = {k: F.coalesce(F.col(f"_prev_{c}")[k], F.col(f"_earlier_{k}_{c}")) for k in "tvp"}
        after = {k: F.coalesce(F.col(f"_next_{c}")[k], F.col(f"_later_{k}_{c}")) for k in "tv"}
        share = F.try_divide((clock - before["t"]).cast("double"), (after["t"] - before["t"]).cast("double"))
        between = before["v"] + (after["v"] - before["v"]) * share
        near = F.col(POS) - before["p"] <= limit
        return F.coalesce(value[c], F.when(near, F.coalesce(between, before["v"])))

    kept = [c for c in df.columns if c not in series.BOOKKEEPING]
    return marked.select([filled(c).alias(c) if c in columns else F.col(c) for c in kept] + [BLOCK, POS, ROWS])


def clip_negative(df: DataFrame, columns=POLLUTANTS) -> DataFrame:
    """Raise negative amounts to 0; NULL stays NULL."""
    return df.withColumns(
        {c: F.when(F.col(c).isNotNull(), F.greatest(F.col(c), F.lit(0.0))) for c in columns}
    )


def clip_between(value: Column, low: Column, high: Column) -> Column:
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


def cap_outliers(
    df: DataFrame, columns=MEASURES, factor: float = 3.0, layout: Layout = DEFAULT, fit_on: DataFrame | None = None
) -> DataFrame:
    """Clip each column to its city's quartiles widened by ``factor`` ranges.

    ``df`` is a blocked series. It is written once, since the quartiles and the caller both
    read it, and comes back with fresh positions. The quartiles are its own, or
    those of ``fit_on``.
    """

    def bounds(written):
        return iqr_bounds(written if fit_on is None else fit_on, columns, factor, (layout.key,))

    # The quartiles read the written table itself, not the frame that already joins the positions.
    return clip_to_bounds(series.stage_numbered(df, layout, "capped", bounds), columns)


def clip_to_bounds(df: DataFrame, columns) -> DataFrame:
    """Clip each column to its row's ``<column>_low`` and ``<column>_high``, which go."""
    return df.withColumns(
        {c: clip_between(F.col(c), F.col(f"{c}_low"), F.col(f"{c}_high")) for c in columns}
    ).drop(*[f"{c}_{end}" for c in columns for end in ("low", "high")])


def clean_series(df: DataFrame, layout: Layout = DEFAULT, limit: int = 3, factor: float = 3.0) -> DataFrame:
    """Interpolate, drop what stays incomplete, cap outliers, clip negatives.

    The order matters: quartiles are taken after the drop. The result carries fresh
    positions for feature building.
    """
    kept = drop_incomplete(interpolate_time(nan_to_null(df), MEASURES, limit, layout), MEASURES)
    return clip_negative(cap_outliers(kept, MEASURES, factor, layout))


def fill_edges(df: DataFrame, columns, layout: Layout = DEFAULT) -> DataFrame:
    """Forward fill, then backward fill, over a blocked series without halo.

    The series is written once; what lies beyond a block comes from one small row per
    block, for both directions.
    """
    written = write_and_reread(df, "edges")
    here = {c: F.col(c) for c in columns}
    named = [e.alias(n) for n, e in series.known_summaries(here, POS).items()]
    blocks = written.groupBy(layout.key, BLOCK).agg(*named)
    beyond = blocks.select(layout.key, BLOCK, *[e.alias(n) for n, e in series.carried(blocks, here, layout).items()])
    upto = series.block_window(layout).rowsBetween(Window.unboundedPreceding, 0)
    onward = series.block_window_reversed(layout).rowsBetween(Window.unboundedPreceding, 0)
    rows = written.join(beyond, [layout.key, BLOCK])
    rows = rows.select("*", *[F.last(c, ignorenulls=True).over(upto).alias(f"_upto_{c}") for c in columns])
    rows = rows.select("*", *[F.last(c, ignorenulls=True).over(onward).alias(f"_onward_{c}") for c in columns])
    sides = ("_upto_", "_earlier_", "_onward_", "_later_")
    return rows.select([F.coalesce(*[f"{s}{c}" for s in sides]).alias(c) if c in columns else F.col(c) for c in df.columns])
