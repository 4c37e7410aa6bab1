"""The three feature sets, calendar parts and text rules."""

from pyspark.sql import functions as F

from catalog.fixture import HOURLY, SAMPLED, cleaned, events, readings, scored_samples, with_tables
from catalog.registry import query, r, rounded
from hazeline import series
from hazeline.functions import calendar, text
from hazeline.operators.features import EXPLAIN, SERVE, TRAIN, add_features, build_features
from hazeline.operators.projection import drop_incomplete
from hazeline.schemas import POLLUTANTS
from hazeline.session import scratch_path
from hazeline.streaming import features as streaming

AQI_LAGS = (1, 2, 3, 6, 12, 24, 48, 72)


class FeatureSql:
    """SQL for one feature set, written out apart from the library's rules."""

    def __init__(self, order="timestamp"):
        self.rows = f"PARTITION BY city ORDER BY {order}"

    def lag(self, column, k):
        return f"lag({column}, {k}) OVER ({self.rows})" if k else column

    def roll(self, function, column, width, skip):
        end = f"{skip} PRECEDING" if skip else "CURRENT ROW"
        frame = f"({self.rows} ROWS BETWEEN {width - 1 + skip} PRECEDING AND {end})"
        return f"CASE WHEN count({column}) OVER {frame} = {width} THEN {function}({column}) OVER {frame} END"

    def difference(self, k, skip):
        return f"({self.lag('aqi', skip)} - {self.lag('aqi', skip + k)})"

    def columns(self, kind):
        out = {f"aqi_lag_{k}h": f"{self.lag('aqi', k)}::DOUBLE" for k in AQI_LAGS}
        skip = 1 if kind == "train" else 0
        prefix, side = ("pm2_5", (1, 2, 3)) if kind == "serve" else ("pm25", (1, 3, 6, 24))
        for k in side:
            out[f"{prefix}_lag_{k}h"] = self.lag("pm2_5", k)
            out[f"co_lag_{k}h"] = self.lag("co", k)
        for w in (3, 6, 12, 24):
            out[f"aqi_roll_mean_{w}h"] = self.roll("avg", "aqi", w, skip)
            std = self.roll("stddev_samp", "aqi", w, skip)
            out[f"aqi_roll_std_{w}h"] = f"coalesce({std}, 0.0)" if kind == "serve" else std
        if kind != "serve":
            for c in ("pm2_5", "co", "no2"):
                for w in (6, 24):
                    out[f"{c}_roll_mean_{w}h"] = self.roll("avg", c, w, skip)
            for k in (1, 3, 24):
                out[f"aqi_diff_{k}h"] = f"{self.difference(k, skip)}::DOUBLE"
        if kind == "train":
            out["aqi_trend"] = f"sign({self.difference(1, 1)})::DOUBLE"
        elif kind == "explain":
            known = f"count(aqi) OVER ({self.rows} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) = 4"
            out["aqi_trend"] = f"CASE WHEN {known} THEN (aqi - {self.lag('aqi', 3)}) / 3.0::DOUBLE END"
        else:
            out["aqi_rate_1h"] = f"{self.difference(1, 0)}::DOUBLE"
            out["aqi_rate_3h"] = f"{self.difference(3, 0)}::DOUBLE"
            out["aqi_trend_dir"] = f"CASE WHEN {self.difference(1, 0)} > 0 THEN 1 ELSE 0 END"
            out["aqi_accel"] = f"(aqi - 2 * {self.lag('aqi', 1)} + {self.lag('aqi', 2)})::DOUBLE"
        out.update(time_sql("timestamp", kind))
        return out


def time_sql(ts, kind="train"):
    parts = {
        "hour": f"hour({ts})", "day_of_week": f"isodow({ts}) - 1", "month": f"month({ts})",
        "day_of_year": f"dayofyear({ts})",
    }
    out = dict(parts)
    cycles = [("hour", "hour", 24), ("month", "month", 12), ("dow", "day_of_week", 7)]
    cycles += [("doy", "day_of_year", 365)] if kind == "serve" else []
    for name, part, period in cycles:
        out[f"{name}_sin"] = f"sin(2 * pi() * ({parts[part]}) / {period})"
        out[f"{name}_cos"] = f"cos(2 * pi() * ({parts[part]}) / {period})"
    peaks = {"train": ("6 AND 9", "19 AND 22"), "explain": ("7 AND 9", "17 AND 20"), "serve": ("7 AND 10", "17 AND 20")}
    for name, hours in zip(("is_morning_peak", "is_evening_peak"), peaks[kind]):
        out[name] = f"CASE WHEN hour({ts}) BETWEEN {hours} THEN 1 ELSE 0 END"
    summer = "6 AND 9" if kind == "train" else "6 AND 8"
    out["season"] = (f"CASE WHEN month({ts}) IN (12, 1, 2) THEN 0 WHEN month({ts}) BETWEEN 3 AND 5 THEN 1 "
                     f"WHEN month({ts}) BETWEEN {summer} THEN 2 ELSE 3 END")
    return out


def _is_int(name):
    return name in {"hour", "day_of_week", "month", "day_of_year", "season", "aqi_trend_dir"} or name.startswith("is_")


def _select(names):
    return ", ".join(n if _is_int(n) else r(n) for n in names)


def _featured(kind, source, keep, order="timestamp"):
    built = FeatureSql(order).columns(kind)
    inner = ", ".join(f"{e} AS {n}" for n, e in built.items())
    return list(built), f"SELECT {keep}, aqi::DOUBLE AS aqi, {', '.join(POLLUTANTS)}, {inner} FROM {source}"


def _dropped_sql(kind, source, tail=None):
    names, inner = _featured(kind, source, "city, timestamp")
    every = ["aqi", *POLLUTANTS, *names]
    body = f"SELECT * FROM featured WHERE {' AND '.join(f'{n} IS NOT NULL' for n in every)}"
    if tail:
        body = (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) AS back "
                f"FROM ({body})) WHERE back <= {tail}")
    return with_tables(f"SELECT city, timestamp, {_select(every)} FROM ({body})", source, extra={"featured": inner})


def _double_target(df):
    return df.withColumn("aqi", F.col("aqi").cast("double"))


@query("W1 W2 W4 W5 W7 W8 W11 T1 T2 T3 T4 T5 T7 T8 P5", _dropped_sql("train", "cleaned"))
def training_features(spark, sf_dir):
    built = build_features(cleaned(spark, sf_dir), TRAIN, HOURLY)
    return rounded(built.select("city", "timestamp", "aqi", *TRAIN.names))


#: Added on both sides before rounding, for means that lie half-way between two last places.
NUDGE = 1e-9


@query("W1 W2 W6 W7 W9 W12 T7 T8 P5", _dropped_sql("explain", "cleaned").replace("round(", f"round({NUDGE}::DOUBLE + "))
def explaining_features(spark, sf_dir):
    built = build_features(cleaned(spark, sf_dir), EXPLAIN, HOURLY).select("city", "timestamp", "aqi", *EXPLAIN.names)
    return rounded(built.select([(F.col(n) + NUDGE).alias(n) if t == "double" else n for n, t in built.dtypes]))


def _serving_sql():
    names, inner = _featured("serve", "local", "city, timestamp")
    every = ["aqi", *POLLUTANTS, *names]
    up = "(PARTITION BY city ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    down = "(PARTITION BY city ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    fills = ", ".join(
        f"coalesce(last_value({n} IGNORE NULLS) OVER {up}, first_value({n} IGNORE NULLS) OVER {down}) AS {n}"
        for n in every)
    local = f"SELECT city, timestamp + INTERVAL 5 HOUR AS timestamp, aqi, {', '.join(POLLUTANTS)} FROM readings"
    return with_tables(f"SELECT city, timestamp, {_select(every)} FROM edges", "readings",
                       extra={"local": local, "featured": inner,
                              "edges": f"SELECT city, timestamp, {fills} FROM featured"})


@query("W1 W3 W6 W10 W13 W14 T6 T7 T8 T10 C6 C7", _serving_sql())
def serving_features(spark, sf_dir):
    local = readings(spark, sf_dir).withColumn("timestamp", calendar.to_local(F.col("timestamp")))
    built = build_features(series.number_rows(local, HOURLY), SERVE, HOURLY)
    return rounded(_double_target(built).select("city", "timestamp", "aqi", *SERVE.names))


def _per_sample_sql():
    names, inner = _featured("train", "scored", "event_id", "timestamp, event_id")
    return with_tables(f"SELECT event_id, {_select(names)} FROM featured", "scored", extra={"featured": inner})


@query("W1 W2 W4 W5 W7 W8 W11", _per_sample_sql())
def training_features_samples(spark, sf_dir):
    built = add_features(series.number_rows(scored_samples(spark, sf_dir), SAMPLED), TRAIN, SAMPLED)
    return rounded(built.select("event_id", *[n for n in TRAIN.names if n not in POLLUTANTS]))


def _streamed_sql():
    names, inner = _featured("train", "readings", "city, timestamp")
    ends = "SELECT city, max(timestamp) AS own_end, max(max(timestamp)) OVER () AS all_end FROM readings GROUP BY city"
    return with_tables(
        f"SELECT city, timestamp, {_select(names)} FROM featured JOIN ends USING (city) "
        "WHERE timestamp <= greatest(own_end - INTERVAL 2 HOUR, all_end - INTERVAL 6 HOUR)",
        "readings", extra={"featured": inner, "ends": ends})


@query("R4 W1 W2 W4 W5 W7 W8", _streamed_sql())
def streamed_features(spark, sf_dir):
    """Features of a stream of files that arrive in three deliveries, with state per city.

    The rows of the last two hours are still held, for whatever comes late.
    """
    path, rows = scratch_path(spark, "streamed"), readings(spark, sf_dir)
    clock = F.unix_seconds("timestamp")
    first, last = rows.agg(F.min(clock), F.max(clock)).first()
    share = (clock - first) * 3 / (last - first + 1)
    for third in range(3):
        rows.where(F.floor(share) == third).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
        streaming.feature_stream(stream, f"{path}/out", f"{path}/late", f"{path}/log", TRAIN, HOURLY).awaitTermination()
    got = spark.read.parquet(f"{path}/out")
    return rounded(got.select("city", "timestamp", *[n for n in TRAIN.names if n not in POLLUTANTS]))


# --- calendar ---------------------------------------------------------------


@query("T1 T2 T3 T4 T5 T6 T7 T8", "SELECT event_id, " + ", ".join(
    f"{e} AS {n}" if _is_int(n) else r(e, n) for n, e in time_sql("ts", "serve").items()) + " FROM events")
def calendar_parts(spark, sf_dir):
    rows = events(spark, sf_dir)
    return rounded(rows.select("event_id", *[e.alias(n) for n, e in SERVE.time_features(F.col("ts")).items()]))


def _register_calendar_year(kind, spec):
    """Calendar features over all days of a leap year, since the events lie in one month."""
    parts = time_sql("ts", kind)

    def run(spark, sf_dir):
        shifted = F.col("ts").cast("timestamp") + F.make_dt_interval((F.col("event_id") % 366).cast("int"))
        rows = events(spark, sf_dir).select("event_id", shifted.alias("ts"))
        return rounded(rows.select("event_id", *[e.alias(n) for n, e in spec.time_features(F.col("ts")).items()]))

    run.__name__ = f"calendar_year_{kind}"
    shown = ", ".join(f"{e} AS {n}" if _is_int(n) else r(e, n) for n, e in parts.items())
    query("T3 T4 T5 T6 T7 T8", f"SELECT event_id, {shown} FROM "
          "(SELECT event_id, ts + to_days(cast(event_id % 366 AS INTEGER)) AS ts FROM events)")(run)


for _kind, _spec in {"train": TRAIN, "explain": EXPLAIN, "serve": SERVE}.items():
    _register_calendar_year(_kind, _spec)


@query("T9 X4", "SELECT event_id, strftime(ts, '%a') AS day_name, dayname(ts)[1:3] AS cut_name FROM events")
def day_names(spark, sf_dir):
    ts = F.col("ts")
    return events(spark, sf_dir).select(
        "event_id", calendar.day_name(ts).alias("day_name"),
        F.substring(F.date_format(ts, "EEEE"), 1, 3).alias("cut_name"),
    )


@query("T10", "SELECT event_id, ts + INTERVAL 5 HOUR AS local_time FROM events")
def local_clock(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", calendar.to_local(F.col("ts").cast("timestamp")).alias("local_time")
    )


@query("T11", "SELECT event_id, date_trunc('hour', ts)::TIMESTAMP AS hour_start, "
              "date_trunc('day', ts)::TIMESTAMP AS day_start FROM events")
def truncated_times(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", F.date_trunc("hour", "ts").alias("hour_start"), F.date_trunc("day", "ts").alias("day_start")
    )


@query("T12", "SELECT event_id, strftime(ts, '%d %b %Y, %H:%M PKT') AS updated, "
              "concat('Tomorrow · ', strftime(ts, '%a %d %b')) AS first_label, "
              "concat('Day 2 · ', strftime(ts, '%a %d %b')) AS second_label FROM events")
def time_labels(spark, sf_dir):
    ts = F.col("ts")
    return events(spark, sf_dir).select(
        "event_id",
        calendar.stamp_label(ts).alias("updated"),
        calendar.day_label(ts, F.lit(1)).alias("first_label"),
        calendar.day_label(ts, F.lit(2)).alias("second_label"),
    )


@query("T13", "SELECT event_id, ts + to_hours((event_id % 72 + 1)::INTEGER) AS later, "
              "ts + INTERVAL 3 DAY AS three_days_on FROM events")
def shifted_times(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    hours = (F.col("event_id") % 72 + 1).cast("int")
    return events(spark, sf_dir).select(
        "event_id", calendar.add_hours(ts, hours).alias("later"), calendar.add_days(ts, F.lit(3)).alias("three_days_on")
    )


# --- text -------------------------------------------------------------------

_WORD = "CASE WHEN regexp_matches(w, '^[0-9]') THEN upper(w) ELSE concat(upper(w[1]), lower(w[2:])) END"


@query("X1 X2", "SELECT event_id, name, array_to_string(list_transform(string_split(replace(name, '_', ' '), ' '), "
                f"lambda w: {_WORD}), ' ') AS label FROM "
                "(SELECT event_id, concat(event_type, '_lag_', user_id % 72, 'h') AS name FROM events)")
def feature_labels(spark, sf_dir):
    name = F.concat("event_type", F.lit("_lag_"), (F.col("user_id") % 72).cast("string"), F.lit("h"))
    rows = events(spark, sf_dir).select("event_id", name.alias("name"))
    return rows.withColumn("label", text.feature_label(F.col("name")))


@query("X3 X5", "SELECT event_id, upper(event_type) AS heading, cast(trunc(value) AS INTEGER) AS whole, "
                "printf('%.1f', value * 4) AS shown, "
                "concat(lpad(cast(hour(ts) AS VARCHAR), 2, '0'), ':00') AS clock FROM events")
def text_formats(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id",
        F.upper("event_type").alias("heading"),
        F.col("value").cast("int").alias("whole"),
        text.one_decimal(F.col("value") * 4).alias("shown"),
        text.hour_label(F.hour("ts")).alias("clock"),
    )
