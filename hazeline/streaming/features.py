"""Incremental lag and rolling features of a stream, with state per city.

Lags and windows count rows, which no streaming window does. Spark's state store keeps,
for each city, the rows that are held back and the newest ``spec.reach`` rows that have
left; a micro-batch touches the cities that sent rows or whose timer went off, and no other.

Rows may arrive out of order: a city's rows are held until its newest row is past them by
the allowed lateness, and then leave in the order of time. A city that sends nothing more
would hold its last rows for ever, so a timer in event time releases them when the watermark,
``idle`` behind the newest row of all cities, has passed them. The rows that leave go through
the batch feature code together with the rows before them. What comes later still is
written to a table of its own, so nothing vanishes.

One call sees the rows that one city sends in one micro-batch, which ``maxFilesPerTrigger``
of the source bounds, together with its state.
"""

import pickle

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazeline import series
from hazeline.operators.features import TRAIN, FeatureSpec, add_features
from hazeline.series import DEFAULT, POS, ROWS, Layout
from hazeline.streaming.ingest import LATENESS

IDLE = "6 hours"
NEW, LATE, MARK = "_new", "_late", "_mark"


def with_beats(readings: DataFrame, idle: str, layout: Layout = DEFAULT) -> DataFrame:
    """The rows with a watermark that none of them can fall behind.

    Spark drops rows behind the watermark before they reach the state. So the watermark is
    of a column that is null in the rows themselves; copies of them with the time in it
    move the watermark and go no further.
    """
    nothing, time = F.lit(None).cast("timestamp"), F.col(layout.time)
    marks = F.when(time.isNull(), F.array(nothing)).otherwise(F.array(nothing, time))
    return readings.withColumn(MARK, F.explode(marks)).withWatermark(MARK, idle).where(F.col(MARK).isNull())


def _holder(columns: list[str], reach: int, lateness: str, layout: Layout):
    """The state function of a city: rows in; rows that leave, those before them, and late ones out."""
    time, order, lag = layout.time, [layout.time, *layout.ties], pd.Timedelta(lateness)

    def hold(key, batches, state):
        left, closed, kept = (*state.get[:2], pickle.loads(state.get[2])) if state.exists else (0, None, None)
        context, held = kept or (None, None)
        watermark = pd.Timestamp(max(state.getCurrentWatermarkMs(), 0), unit="ms")
        parts = [] if state.hasTimedOut else [b[columns] for b in batches]
        new = pd.concat(parts) if parts else None
        if new is not None:
            late = new[time].isna() | (key[0] is None)
            if closed is not None:
                late |= new[time] <= pd.Timestamp(closed)
            if late.any():
                yield new[late].assign(**{POS: -1, ROWS: -1, NEW: True, LATE: True})
            held = new[~late] if held is None else pd.concat([held, new[~late]])
        if held is None or not len(held):
            if context is not None:
                state.update((left, closed, pickle.dumps((context, None))))
            return
        held = held.sort_values(order, kind="stable")
        ready = held[time] <= max(held[time].iloc[-1] - lag, watermark)
        leaving, held = held[ready], held[~ready]
        if len(leaving):
            before = 0 if context is None else len(context)
            rows = leaving if context is None else pd.concat([context, leaving])
            places = range(left - before, left + len(leaving))
            left, closed = left + len(leaving), leaving[time].iloc[-1].to_pydatetime()
            yield rows.assign(**{POS: places, ROWS: left, NEW: [i >= left - len(leaving) for i in places], LATE: False})
            context = rows.iloc[-reach:]
        state.update((left, closed, pickle.dumps((context, held))))
        if len(held):
            due = int(held[time].iloc[0].value // 1_000_000) - 1  # a timer goes off after its time
            state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs()))

    return hold


def leaving_rows(
    readings: DataFrame, spec: FeatureSpec, layout: Layout = DEFAULT, lateness: str = LATENESS, idle: str = IDLE
) -> DataFrame:
    """The stream of rows that leave, with their positions, the rows before them, and late rows."""
    columns = readings.columns
    schema = readings.schema
    for name, kind in ((POS, "long"), (ROWS, "long"), (NEW, "boolean"), (LATE, "boolean")):
        schema = schema.add(name, kind) if name not in schema.names else schema
    return with_beats(readings, idle, layout).groupBy(layout.key).applyInPandasWithState(
        _holder(columns, spec.reach, lateness, layout), schema, "left long, closed timestamp, rows binary", "append", "EventTimeTimeout"
    )


def batch_features(rows: DataFrame, spec: FeatureSpec, layout: Layout = DEFAULT) -> DataFrame:
    """Features of the new rows of a micro-batch, in which the rows before them are present."""
    placed = rows.where(~F.col(LATE)).drop(LATE)
    featured = add_features(placed, spec, layout)
    return series.drop_bookkeeping(featured.where(F.col(NEW))).drop(NEW)


def feature_stream(
    readings: DataFrame, path: str, late_path: str, checkpoint: str, spec: FeatureSpec = TRAIN,
    layout: Layout = DEFAULT, lateness: str = LATENESS, idle: str = IDLE,
) -> StreamingQuery:
    """Write features of a stream of readings, and its late rows, one folder per micro-batch.

    A batch overwrites only its own folders, and the state store returns to the state
    before it, so replaying it after a failure gives the same tables.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # written to two tables
        late = batch.where(F.col(LATE)).drop(POS, ROWS, NEW, LATE)
        late.write.mode("overwrite").parquet(f"{late_path}/batch_id={batch_id}")
        batch_features(batch, spec, layout).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        batch.unpersist()

    return (
        leaving_rows(readings, spec, layout, lateness, idle)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
