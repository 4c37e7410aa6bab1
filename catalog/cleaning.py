"""Cleaning steps on hourly readings, each checked on its own."""

from pyspark.sql import functions as F

from catalog.fixture import HOURLY, SAMPLED, cleaned, events, readings, samples, scored_samples, with_tables
from catalog.registry import query, r, rounded
from hazeline import series
from hazeline.operators import cleaning, quantiles
from hazeline.schemas import MEASURES, POLLUTANTS

KEYS = ("city", "timestamp")


def _columns(names):
    return ", ".join(r(n) for n in names)


@query("C1", "SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS timestamp FROM events")
def parse_times(spark, sf_dir):
    stamp = F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise("n/a")
    return cleaning.parse_times(events(spark, sf_dir).select("event_id", stamp.alias("timestamp")))


@query("C2", with_tables(
    "SELECT city, " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}_missing" for c in MEASURES)
    + " FROM readings GROUP BY city", "readings"))
def missing_counts(spark, sf_dir):
    return cleaning.missing_counts(readings(spark, sf_dir))


@query("C3", with_tables(f"SELECT city, timestamp, {_columns(MEASURES)} FROM filled", "filled"))
def interpolate_gaps(spark, sf_dir):
    filled = cleaning.interpolate_time(readings(spark, sf_dir), layout=HOURLY)
    return rounded(filled.select(*KEYS, *MEASURES))


@query("C4 A6", with_tables(
    "SELECT city, p AS column, round(q1, 6) + 0.0 AS q1, round(q3, 6) + 0.0 AS q3 FROM ("
    + " UNION ALL ".join(
        f"SELECT city, '{c}' AS p, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 "
        f"FROM scored GROUP BY city" for c in (*POLLUTANTS, "aqi")) + ")", "scored"))
def quartiles_samples(spark, sf_dir):
    return rounded(quantiles.quartiles(scored_samples(spark, sf_dir), MEASURES))


_FINE = "SELECT concat('city_', cast(user_id % 4 AS varchar)) AS city, value / 1e7::DOUBLE AS fine FROM events"


@query("A6", f"SELECT city, 'fine' AS column, {r('q1 * 1e7', 'q1')}, {r('q3 * 1e7', 'q3')} FROM (SELECT city, quantile_cont(fine, 0.25) AS q1, "
             f"quantile_cont(fine, 0.75) AS q3 FROM ({_FINE}) GROUP BY city)")
def quartiles_within_one_unit(spark, sf_dir):
    """All values lie close together, and bins of more than 20 are split again."""
    city = F.concat(F.lit("city_"), (F.col("user_id") % 4).cast("string")).alias("city")
    fine = events(spark, sf_dir).select(city, (F.col("value") / 1e7).alias("fine"))
    found = quantiles.quartiles(fine, ["fine"], most=20)
    return rounded(found.select("city", "column", *[(F.col(q) * 1e7).alias(q) for q in ("q1", "q3")]))


@query("C4", with_tables(
    "SELECT city, " + ", ".join(
        f"{r(f'least(greatest({c}, q1_{c} - 3.0 * (q3_{c} - q1_{c})), q3_{c} + 3.0 * (q3_{c} - q1_{c}))', c)}"
        for c in MEASURES) + ", timestamp FROM kept JOIN quartile_row USING (city)", "quartile_row"))
def cap_outliers(spark, sf_dir):
    filled = cleaning.interpolate_time(readings(spark, sf_dir), layout=HOURLY)
    kept = filled.na.drop(subset=list(MEASURES))
    return rounded(cleaning.cap_outliers(kept, layout=HOURLY).select(*KEYS, *MEASURES))


@query("C5", "SELECT event_id, CASE WHEN event_type <> 'view' THEN greatest(value - 30, 0) END AS pm2_5 FROM events")
def clip_negative(spark, sf_dir):
    shifted = F.when(F.col("event_type") != "view", F.col("value") - 30)
    return cleaning.clip_negative(events(spark, sf_dir).select("event_id", shifted.alias("pm2_5")), ["pm2_5"])


_FORWARD = "(PARTITION BY city ORDER BY timestamp, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_BACKWARD = "(PARTITION BY city ORDER BY timestamp, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


@query("C6", with_tables(
    "SELECT event_id, " + ", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER {_FORWARD}, first_value({c} IGNORE NULLS) OVER {_BACKWARD}) AS {c}"
        for c in POLLUTANTS) + " FROM samples", "samples"))
def fill_edges(spark, sf_dir):
    return cleaning.fill_edges(series.number_rows(samples(spark, sf_dir), SAMPLED), POLLUTANTS, SAMPLED).select("event_id", *POLLUTANTS)


@query("C1 C3 P4 C4 C5", with_tables(f"SELECT city, timestamp, {_columns(MEASURES)} FROM cleaned", "cleaned"))
def cleaned_series(spark, sf_dir):
    return rounded(cleaned(spark, sf_dir).select(*KEYS, *MEASURES))
