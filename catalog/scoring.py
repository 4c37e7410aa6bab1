"""Index scoring, categories, guideline shares, row-level projections."""

from pyspark.sql import functions as F

from catalog.fixture import composite_sql, events, readings, sub_index_sql, samples, scored_samples, with_tables
from catalog.registry import query, r, rounded
from hazeline.functions import aqi
from hazeline.operators import projection
from hazeline.schemas import POLLUTANTS

VALUE_SQL = {p: "value" for p in POLLUTANTS} | {
    "co": "cast(json_extract_string(props, '$.k') AS DOUBLE) * 150.0::DOUBLE"
}


def _register_sub_index(pollutant, covers):
    def run(spark, sf_dir):
        value = F.col("value")
        if pollutant == "co":
            value = F.get_json_object("props", "$.k").cast("double") * 150.0
        scored = events(spark, sf_dir).select("event_id", value.alias("amount"))
        return scored.withColumn("score", aqi.sub_index(pollutant, F.col("amount")))

    run.__name__ = f"sub_index_{pollutant}"
    query(
        covers,
        f"SELECT event_id, amount, {sub_index_sql(pollutant, 'amount')} AS score "
        f"FROM (SELECT event_id, {VALUE_SQL[pollutant]} AS amount FROM events)",
    )(run)


for _pollutant, _covers in {"pm2_5": "Q1 Q2", "pm10": "Q3", "no2": "Q4", "o3": "Q5", "so2": "Q6", "co": "Q7"}.items():
    _register_sub_index(_pollutant, _covers)

_READING = ", ".join(POLLUTANTS)


@query("Q8 Q9", with_tables(f"SELECT event_id, aqi, {_READING} FROM scored", "scored"))
def composite_index_samples(spark, sf_dir):
    vendor = samples(spark, sf_dir).withColumn("aqi", F.lit(3))
    return aqi.with_aqi(vendor).select("event_id", "aqi", *POLLUTANTS)


@query("Q8 Q9", with_tables(f"SELECT city, timestamp, aqi, {_READING} FROM readings", "readings"))
def composite_index_hourly(spark, sf_dir):
    return readings(spark, sf_dir)


@query("Q8", with_tables(f"SELECT event_id, {composite_sql(contiguous=True)} AS aqi FROM samples", "samples"))
def composite_index_contiguous(spark, sf_dir):
    return aqi.with_aqi(samples(spark, sf_dir), mode="contiguous").select("event_id", "aqi")


# Fixed values of the health categories: upper limit, name, colour, tint, icon and message.
_PARTS = ("category", "color", "tint", "icon", "message")
_CATEGORIES = [
    (50, "Good", "#00E400", "rgba(0,228,0,0.12)", "🟢",
     "Air quality is satisfactory and poses little or no risk. Enjoy outdoor activities freely."),
    (100, "Moderate", "#D4B800", "rgba(255,215,0,0.12)", "🟡",
     "Air quality is acceptable. Unusually sensitive individuals should consider reducing prolonged outdoor exertion."),
    (150, "Unhealthy for Sensitive Groups", "#FF7E00", "rgba(255,126,0,0.12)", "🟠",
     "Sensitive groups may experience health effects. The general public is not likely to be affected."),
    (200, "Unhealthy", "#FF0000", "rgba(255,0,0,0.12)", "🔴",
     "Everyone may begin to experience health effects. Limit prolonged outdoor exertion."),
    (300, "Very Unhealthy", "#8F3F97", "rgba(143,63,151,0.12)", "🟣",
     "Health alert — everyone may experience serious health effects. Wear N95 masks if going outside."),
    (None, "Hazardous", "#7E0023", "rgba(126,0,35,0.12)", "⛔",
     "🚨 Emergency conditions. Stay indoors, seal windows, use air purifiers."),
]
# The guideline amount of each pollutant.
_GUIDELINES = {"pm2_5": 75.0, "pm10": 150.0, "no2": 100.0, "so2": 75.0, "o3": 100.0, "co": 4.0}


def category_sql(value: str, part: str = "category") -> str:
    shown = f"greatest(0, cast(trunc(coalesce({value}, 0)) AS INTEGER))"
    values = [(row[0], row[1 + _PARTS.index(part)]) for row in _CATEGORIES]
    arms = " ".join(f"WHEN {shown} <= {limit} THEN '{value}'" for limit, value in values[:-1])
    return f"CASE {arms} ELSE '{values[-1][1]}' END"


@query(
    "Q10",
    "SELECT event_id, greatest(0, cast(trunc(coalesce(scaled, 0)) AS INTEGER)) AS shown, "
    + ", ".join(f"{category_sql('scaled', part)} AS {part}" for part in _PARTS)
    + " FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value * 3.0::DOUBLE - 20 END AS scaled "
      "FROM events)",
)
def health_category(spark, sf_dir):
    scaled = F.when(F.col("event_type") != "error", F.col("value") * 3.0 - 20)
    rows = events(spark, sf_dir).select("event_id", scaled.alias("scaled"))
    return aqi.with_category(rows, "scaled").select(
        "event_id", aqi.display_value(F.col("scaled")).alias("shown"), "category", "color", "tint", "icon", "message"
    )


def _guideline_sql(convert: bool) -> str:
    def arm(name, limit):
        amount = f"coalesce({name}, 0.0)" + (" / 1000.0::DOUBLE" if convert and name == "co" else "")
        return f"SELECT event_id, '{name}' AS pollutant, {amount} AS amount, {limit}::DOUBLE AS guideline FROM samples"

    union = " UNION ALL ".join(arm(n, limit) for n, limit in _GUIDELINES.items())
    return with_tables(
        f"SELECT event_id, pollutant, {r('amount')}, guideline, {r('least(amount / guideline * 100.0, 100.0)', 'percent')}, "
        f"least(amount / guideline * 100.0, 100.0) >= 80 AS over_80 FROM ({union})",
        "samples",
    )


@query("Q11 P7 P12", _guideline_sql(True))
def guideline_share(spark, sf_dir):
    return rounded(aqi.guideline_percent(samples(spark, sf_dir), keys=("event_id",)))


@query("Q11 P12", _guideline_sql(False))
def guideline_share_raw_units(spark, sf_dir):
    return rounded(aqi.guideline_percent(samples(spark, sf_dir), co_in_milligrams=False, keys=("event_id",)))


@query("Q12", f"SELECT event_id, {r('least(greatest(value * 3.0::DOUBLE - 100, 0), 500)', 'clamped')} FROM events")
def clamp_prediction(spark, sf_dir):
    return rounded(events(spark, sf_dir).select(
        "event_id", aqi.clamp_index(F.col("value") * 3.0 - 100).alias("clamped")
    ))


# --- projections, filters and gates ----------------------------------------

AS_OF = "2024-02-01 06:30:15"


@query("P1", f"SELECT event_id, 'Harbour' AS city, TIMESTAMP '{AS_OF}' AS timestamp, value FROM events")
def ingest_stamp(spark, sf_dir):
    moment = F.lit(AS_OF).cast("timestamp")
    return projection.stamp_ingest(events(spark, sf_dir).select("event_id", "value"), "Harbour", moment)


@query("P2", with_tables("SELECT city, timestamp, pm2_5, pm10, so2, o3, co FROM samples", "samples"))
def select_present_columns(spark, sf_dir):
    return projection.select_present(samples(spark, sf_dir).drop("no2"))


@query("P3", with_tables(f"SELECT event_id, timestamp, {_READING} FROM samples", "samples"))
def drop_identity(spark, sf_dir):
    return samples(spark, sf_dir).drop("city")


@query("P4", with_tables(
    "SELECT city, timestamp, pm2_5, no2, so2 FROM readings WHERE pm2_5 IS NOT NULL AND no2 IS NOT NULL", "readings"))
def drop_incomplete_subset(spark, sf_dir):
    rows = readings(spark, sf_dir).select("city", "timestamp", "pm2_5", "no2", "so2")
    return projection.drop_incomplete(rows, ["pm2_5", "no2"])


@query("P5", with_tables(
    f"SELECT city, timestamp, aqi, {_READING} FROM readings WHERE "
    + " AND ".join(f"{p} IS NOT NULL" for p in POLLUTANTS), "readings"))
def drop_incomplete_rows(spark, sf_dir):
    return projection.drop_incomplete(readings(spark, sf_dir))


@query("P6", with_tables(
    "SELECT event_id, pm2_5, 0.0::DOUBLE AS aqi_lag_1h, aqi::DOUBLE AS aqi, 0.0::DOUBLE AS season, co FROM scored",
    "scored"))
def align_to_model(spark, sf_dir):
    rows = scored_samples(spark, sf_dir)
    return projection.align_features(rows, ["pm2_5", "aqi_lag_1h", "aqi", "season", "co"], keep=("event_id",))


@query("P7", with_tables("SELECT event_id, coalesce(pm10, 0.0) AS pm10, 0.0::DOUBLE AS nh3 FROM samples", "samples"))
def missing_as_zero(spark, sf_dir):
    rows = samples(spark, sf_dir)
    return rows.select("event_id", *[projection.zero_if_absent(rows, n).alias(n) for n in ("pm10", "nh3")])


@query("P8", with_tables(
    "SELECT event_id, city, timestamp FROM samples WHERE timestamp >= TIMESTAMP '2024-01-10' "
    "AND timestamp < TIMESTAMP '2024-01-11'", "samples"))
def one_day_range(spark, sf_dir):
    start = F.lit("2024-01-10").cast("timestamp")
    return samples(spark, sf_dir).where(projection.within_days(start)).select("event_id", "city", "timestamp")


@query("P10", with_tables(
    "SELECT city, count(*) AS rows, count(*) >= 700 AS ready, greatest(700 - count(*), 0) AS remaining "
    "FROM readings GROUP BY city", "readings"))
def history_gate_report(spark, sf_dir):
    return projection.history_report(readings(spark, sf_dir), 700)


@query("P10", with_tables(
    "SELECT city, timestamp, aqi FROM readings WHERE city IN "
    "(SELECT city FROM readings GROUP BY city HAVING count(*) >= 700)", "readings"))
def history_gate(spark, sf_dir):
    return projection.with_enough_history(readings(spark, sf_dir).select("city", "timestamp", "aqi"), 700)


_INCOMPLETE = " OR ".join(f"{p} IS NULL" for p in POLLUTANTS)


@query("P11", with_tables(
    f"SELECT city, count(*) AS rows_before, count(*) FILTER ({_INCOMPLETE}) AS rows_dropped, "
    f"count(*) FILTER (NOT ({_INCOMPLETE})) AS rows_after FROM readings GROUP BY city", "readings"))
def drop_counts(spark, sf_dir):
    return projection.drop_report(readings(spark, sf_dir), POLLUTANTS)
