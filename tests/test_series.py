"""Positions of long, dense and undated series."""

import datetime as dt

from pyspark.sql import functions as F

from hazeline import series
from hazeline.operators.cleaning import fill_edges, interpolate_time
from hazeline.series import BLOCK, POS, ROWS, Layout

START = dt.datetime(2024, 1, 1)


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "city string, timestamp timestamp, event_id long, x double")


def test_positions_with_undated_rows(spark):
    rows = [("a", None, i, 1.0) for i in range(5000)] + [("a", START + dt.timedelta(hours=h), 9000 - h, 2.0) for h in range(50)]
    layout = Layout(ties=("event_id",))
    got = series.number_rows(rows_of(spark, rows), layout)
    assert sorted(r[POS] for r in got.collect()) == list(range(5050)) and got.select(ROWS).distinct().collect() == [(5050,)]
    dated = got.where("timestamp IS NOT NULL").orderBy(POS).collect()
    assert [r[POS] for r in dated] == list(range(5000, 5050)) and [r.timestamp for r in dated] == sorted(r.timestamp for r in dated)
    assert got.where("timestamp IS NULL").groupBy(BLOCK).count().agg(F.max("count")).first()[0] < 50


def test_chunks_of_dense_days_are_shortened(spark):
    rows = [("a", START + dt.timedelta(seconds=i), i, 1.0) for i in range(4000)] + [("b", None, 0, 1.0)]
    layout = series.fit_chunks(rows_of(spark, rows), Layout(ties=("event_id",)), target_rows=50)
    assert layout.chunk_seconds == 86_400 // 80
    got = series.number_rows(rows_of(spark, rows).where("city = 'a'"), layout)
    assert [r.event_id for r in got.orderBy(POS).collect()] == list(range(4000))
    assert series.fit_chunks(rows_of(spark, []), layout).chunk_seconds == 86_400


def test_gaps_and_edges_over_many_slices(spark):
    """Values carried over slices that have none, in both directions."""
    known = {0: 1.0, 200: 3.0}
    rows = [("a", START + dt.timedelta(hours=h), h, known.get(h)) for h in range(-100, 300)]
    df = rows_of(spark, rows)
    filled = {r.event_id: r.x for r in interpolate_time(df, ["x"], 3, Layout(ties=("event_id",))).collect()}
    assert {h for h, v in filled.items() if v is not None} == {0, 1, 2, 3, 200, 201, 202, 203}
    assert abs(filled[3] - 1.03) < 1e-9 and filled[203] == 3.0
    edges = {r.event_id: r.x for r in fill_edges(series.number_rows(df, Layout(ties=("event_id",))), ["x"]).collect()}
    assert edges == {h: 1.0 if h < 200 else 3.0 for h in range(-100, 300)}
    assert interpolate_time(df.where("false"), ["x"]).count() == 0


def test_scratch_tables_go_with_their_scope(spark, tmp_path):
    from pathlib import Path

    from hazeline.session import scratch_path, write_and_reread, write_in_scope

    folder = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    made = []

    def make():
        made.append(write_and_reread(spark.range(10), "inner-of-scope"))
        return made[0].where("id > 4")

    kept = write_in_scope(spark, make, "outer-of-scope")
    assert kept.count() == 5 and not list(folder.glob("inner-of-scope-*")) and len(list(folder.glob("outer-of-scope-*"))) == 1
    stays = write_and_reread(spark.range(3), "after-the-scope")
    assert stays.count() == 3
