"""Summaries served to readers: profiles, outlooks, day cards, patterns."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline import series
from hazeline.functions import calendar, text
from hazeline.functions.aqi import category, display_value, with_category
from hazeline.operators.projection import within_days
from hazeline.schemas import CITY, TARGET, TIME
from hazeline.series import DEFAULT, Layout

HOURS = range(24)


def profile(df: DataFrame, by=(CITY,)) -> DataFrame:
    value = F.col(TARGET)
    return df.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.min(value).alias("min_aqi"),
        F.max(value).alias("max_aqi"),
        F.avg(value).alias("mean_aqi"),
        F.min(TIME).alias("first_time"),
        F.max(TIME).alias("last_time"),
    )


def latest_reading(df: DataFrame, by=(CITY,)) -> DataFrame:
    """Each city's newest row; combines before the shuffle, sorts nothing."""
    rest = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.max_by(F.struct(*rest), TIME).alias("_row")).select(*by, "_row.*")


def newest_rows(df: DataFrame, n: int = 500) -> DataFrame:
    """Newest ``n`` rows of the whole table, oldest first."""
    return df.orderBy(F.col(TIME).desc()).limit(n).orderBy(TIME)


def weekly_trend(df: DataFrame, rows: int = 168, layout: Layout = DEFAULT) -> DataFrame:
    """The newest week of hourly rows per city, counted in rows."""
    return series.last_rows(df, rows, layout).select(layout.key, layout.time, TARGET)


def outlook(forecast: DataFrame, by=(CITY,)) -> DataFrame:
    """Average, peak and low of a forecast, each with its category."""
    value = F.col(TARGET)
    summary = forecast.groupBy(*by).agg(
        F.avg(value).alias("avg_aqi"), F.max(value).alias("peak_aqi"), F.min(value).alias("low_aqi")
    )
    return summary.withColumns(
        {f"{name}_category": category(F.col(f"{name}_aqi")) for name in ("avg", "peak", "low")}
    )


def day_summaries(forecast: DataFrame, today: Column, offsets=(1, 2, 3), rows_per_day: int = 24) -> DataFrame:
    """Mean, lowest and highest index of the coming days per city.

    A day is a calendar day counted from ``today``. Where a city has no forecast
    row on that day, rows ``24 k`` to ``24 k + 23`` of its horizon stand in; with
    none of those either the day has no row. Both readings of every forecast row
    are aggregated at once, so this is a single pass.
    """
    base = F.date_trunc("day", today)
    slots = []
    for k in offsets:
        on_day = within_days(calendar.add_days(base, F.lit(k)))
        in_slice = (F.col("horizon") > k * rows_per_day) & (F.col("horizon") <= (k + 1) * rows_per_day)
        slots.append(F.struct(F.lit(k).alias("day_offset"), on_day.alias("on_day"), in_slice.alias("in_slice")))
    rows = forecast.select(CITY, TARGET, F.inline(F.array(*slots))).where(F.col("on_day") | F.col("in_slice"))

    def pick(function, name):
        by_day = function(F.when(F.col("on_day"), F.col(TARGET)))
        by_slice = function(F.when(F.col("in_slice"), F.col(TARGET)))
        return F.when(F.count_if(F.col("on_day")) > 0, by_day).otherwise(by_slice).alias(name)

    summary = rows.groupBy(CITY, "day_offset").agg(
        pick(F.avg, "mean_aqi"), pick(F.min, "min_aqi"), pick(F.max, "max_aqi")
    )
    return with_category(summary, "mean_aqi", ("category", "color"))


def day_cards(summaries: DataFrame, today: Column) -> DataFrame:
    """Day summaries with their labels and the whole numbers shown."""
    day = calendar.add_days(F.date_trunc("day", today), F.col("day_offset"))
    return summaries.select(
        CITY,
        "day_offset",
        calendar.day_label(day, F.col("day_offset")).alias("label"),
        display_value(F.col("mean_aqi")).alias("mean_shown"),
        F.col("min_aqi").cast("int").alias("min_shown"),
        F.col("max_aqi").cast("int").alias("max_shown"),
        "category",
    )


def weekday_hour_pattern(df: DataFrame, by=(CITY,)) -> DataFrame:
    """Mean index per weekday and hour, long form."""
    ts = F.col(TIME)
    return df.groupBy(*by, F.weekday(ts).alias("dow_number"), F.hour(ts).alias("hour")).agg(
        F.avg(TARGET).alias("mean_aqi"), F.count("*").alias("rows")
    )


def weekday_hour_matrix(df: DataFrame, by=(CITY,)) -> DataFrame:
    """Weekday by hour matrix: absent cells are 0, cells without values NULL."""
    cells = weekday_hour_pattern(df, by)
    wide = (
        cells.withColumn("cell", F.struct("mean_aqi", "rows"))
        .groupBy(*by, "dow_number")
        .pivot("hour", list(HOURS))
        .agg(F.first("cell"))
    )
    names = F.array(*[F.lit(name) for name in calendar.WEEKDAYS])
    filled = [F.when(F.col(f"`{h}`").isNull(), F.lit(0.0)).otherwise(F.col(f"`{h}`.mean_aqi")).alias(f"h{h:02d}")
              for h in HOURS]
    return wide.select(*by, "dow_number", F.get(names, F.col("dow_number")).alias("dow"), *filled)


def segment_colors(forecast: DataFrame) -> DataFrame:
    """Mean and colour of each pair of neighbouring forecast rows.

    A forecast holds a fixed horizon per city, so its window is small.
    """
    rows = Window.partitionBy(CITY).orderBy("horizon")
    following = F.lead(TARGET).over(rows)
    return (
        forecast.withColumn("segment_aqi", (F.col(TARGET) + following) / 2.0)
        .where(F.col("segment_aqi").isNotNull())
        .select(CITY, "horizon", "segment_aqi", category(F.col("segment_aqi"), "color").alias("color"))
    )


def point_colors(forecast: DataFrame) -> DataFrame:
    return forecast.select(CITY, "horizon", TARGET, category(F.col(TARGET), "color").alias("color"))


def rank_features(importance: DataFrame, k: int = 8, by=()) -> DataFrame:
    """Top features by importance with rank, share of the largest and label.

    A window here spans one row per feature.
    """
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    order = group.orderBy(F.col("importance").desc(), "feature")
    return (
        importance.withColumn("rank", F.row_number().over(order))
        .withColumn("percent", F.try_divide(F.col("importance"), F.max("importance").over(group)) * 100.0)
        .where(F.col("rank") <= k)
        .withColumn("top_three", F.col("rank") <= 3)
        .withColumn("label", text.feature_label(F.col("feature")))
    )


def advisory(latest: DataFrame) -> DataFrame:
    """The current index with heading, advice and the time it was read."""
    return with_category(latest).select(
        CITY,
        display_value(F.col(TARGET)).alias("value"),
        F.upper("category").alias("heading"),
        "message",
        "color",
        "icon",
        calendar.stamp_label(F.col(TIME)).alias("updated"),
    )
