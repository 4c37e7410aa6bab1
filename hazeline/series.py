"""Positional work on long series without a whole series in one task.

Lags and rolling windows count rows, so the plain plan is one window per city.
One city may hold a third of all rows, which would make that window one task.
Instead each row gets its exact position in its city's series, positions are cut
into blocks of ``block_rows``, and rows near a block's edge are also sent to the
neighbour that needs them as context (a halo). Windows then run per
``(city, block)`` and give the same values as a window per city.

Values from an unbounded distance (next known value, last known value) cross
blocks through a summary of one row per block.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.schemas import CITY, TIME
from hazeline.session import write_and_reread

POS = "_pos"      # 0-based position within the city
ROWS = "_rows"    # number of rows of the city
BLOCK = "_block"  # block a row is processed in
OWN = "_own"      # false for halo rows
CHUNK = "_chunk"  # time slice that positions are first counted in
INDEX = "_index"  # 1-based position within a chunk or block
UNTIMED = 1024    # parts that a city's rows without a time are cut into
BOOKKEEPING = (POS, ROWS, BLOCK, OWN, CHUNK, INDEX)


@dataclass(frozen=True)
class Layout:
    """How series are cut.

    ``chunk_seconds`` bounds what one sort sees while positions are counted;
    hourly series have 24 rows in the default day. ``block_rows`` must be at
    least the widest halo. ``ties`` orders rows that share a timestamp.
    """

    key: str = CITY
    time: str = TIME
    ties: tuple = ()
    chunk_seconds: int = 86_400
    block_rows: int = 8_192

    @property
    def order(self):
        return [F.col(self.time), *map(F.col, self.ties)]


DEFAULT = Layout()


def fit_chunks(df: DataFrame, layout: Layout = DEFAULT, target_rows: int = 1_000_000) -> Layout:
    """Shorten the chunk until the densest city-day fits ``target_rows``.

    One map-side-combined count returning a single row; for dense input only.
    """
    day = F.floor(F.unix_seconds(F.col(layout.time).cast("timestamp")) / 86_400)
    densest = df.groupBy(layout.key, day.alias("day")).count().agg(F.max("count")).first()[0] or 0
    slices = max(1, -(-densest // target_rows))
    seconds = max(1, 86_400 // slices)
    return Layout(layout.key, layout.time, layout.ties, seconds, layout.block_rows)


def chunk_of(layout: Layout = DEFAULT) -> Column:
    """The time slice of a row. Rows without a time come first, in UNTIMED parts drawn by a hash of their ties."""
    seconds = F.unix_seconds(F.col(layout.time).cast("timestamp"))
    part = F.pmod(F.xxhash64(*(layout.ties or ("*",))), F.lit(UNTIMED))
    return F.coalesce(F.floor(seconds / layout.chunk_seconds), F.lit(-(2**62)) + part)


def index_chunks(df: DataFrame, layout: Layout = DEFAULT, label: str = "chunks") -> DataFrame:
    """The series, written once, with its time slices as blocks and the index within each.

    All that needs several looks at the series reads the written table, so that its source
    is scanned once.
    """
    chunked = df.drop(*BOOKKEEPING).withColumn(BLOCK, chunk_of(layout))
    index = F.row_number().over(Window.partitionBy(layout.key, BLOCK).orderBy(*layout.order))
    return write_and_reread(chunked.withColumn(INDEX, index), label)


def block_offsets(indexed: DataFrame, layout: Layout = DEFAULT, summaries: dict[str, Column] | None = None) -> DataFrame:
    """One row per block: ``_before``, the row count of the city, and ``summaries`` of the block."""
    named = [e.alias(name) for name, e in (summaries or {}).items()]
    counts = indexed.groupBy(layout.key, BLOCK).agg(F.max(INDEX).cast("long").alias("_n"), *named)
    city = Window.partitionBy(layout.key)
    earlier = city.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        layout.key,
        BLOCK,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(city).alias(ROWS),
        *(summaries or {}),
    )


def known_summaries(values: dict[str, Column], at: str) -> dict[str, Column]:
    """A block's first and last known value of each expression, in the order of ``at``."""
    known = {name: F.when(v.isNotNull(), F.col(at)) for name, v in values.items()}
    firsts = {f"_first_{name}": F.min_by(v, known[name]) for name, v in values.items()}
    return firsts | {f"_last_{name}": F.max_by(v, known[name]) for name, v in values.items()}


def carried(summaries: DataFrame, names, layout: Layout = DEFAULT) -> dict[str, Column]:
    """Expressions over one row per block for the nearest known values beyond it.

    ``_earlier_<name>`` comes from the blocks before, ``_later_<name>`` from those after.
    """
    city = Window.partitionBy(layout.key)
    before = city.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    after = city.orderBy(F.col(BLOCK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    out = {f"_earlier_{n}": F.last(f"_last_{n}", ignorenulls=True).over(before) for n in names}
    return out | {f"_later_{n}": F.last(f"_first_{n}", ignorenulls=True).over(after) for n in names}


def number_rows(df: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Add the exact position and row count of each city's series."""
    indexed = index_chunks(df, layout)
    return (
        indexed.join(block_offsets(indexed, layout), [layout.key, BLOCK])
        .withColumn(POS, F.col("_before") + F.col(INDEX) - 1)
        .drop("_before", INDEX)
    )


def stage_numbered(df: DataFrame, layout: Layout = DEFAULT, label: str = "series", per_city=None) -> DataFrame:
    """Write a blocked series whose rows were filtered and number it afresh.

    The index within the block needs no further shuffle, and the counts per block
    come from a narrow scan of the written table. ``per_city`` may make one row per
    city from that table; its columns reach all rows with the join that numbers them.
    """
    index = F.row_number().over(block_window(layout))
    kept = [name for name in df.columns if name not in (POS, ROWS, OWN, CHUNK, INDEX)]
    staged = write_and_reread(df.withColumn(INDEX, index).select(*kept, INDEX), label)
    blocks = block_offsets(staged, layout)
    if per_city is not None:
        blocks = blocks.join(per_city(staged), layout.key, "left")
    return (
        staged.join(blocks, [layout.key, BLOCK])
        .withColumn(POS, F.col("_before") + F.col(INDEX) - 1)
        .drop("_before", INDEX)
    )


def split_blocks(df: DataFrame, layout: Layout = DEFAULT, back: int = 0, ahead: int = 0) -> DataFrame:
    """Send each row to its block, and edge rows also to the next or previous one."""
    size = layout.block_rows
    if max(back, ahead) > size:
        raise ValueError(f"halo of {max(back, ahead)} rows needs block_rows >= that")
    home = F.floor(F.col(POS) / size)
    offset = F.col(POS) % size
    nowhere = F.array().cast("array<bigint>")
    targets = [F.array(home)]
    if back:
        needed = (offset >= size - back) & ((home + 1) * size < F.col(ROWS))
        targets.append(F.when(needed, F.array(home + 1)).otherwise(nowhere))
    if ahead:
        needed = (offset < ahead) & (home > 0)
        targets.append(F.when(needed, F.array(home - 1)).otherwise(nowhere))
    return (
        df.drop(BLOCK, OWN)
        .withColumn("_home", home)
        .withColumn(BLOCK, F.explode(F.concat(*targets)))
        .withColumn(OWN, F.col(BLOCK) == F.col("_home"))
        .drop("_home")
    )


def drop_halo(df: DataFrame) -> DataFrame:
    return df.where(F.col(OWN)).drop(OWN)


def drop_bookkeeping(df: DataFrame) -> DataFrame:
    return df.drop(*BOOKKEEPING)


def block_window(layout: Layout = DEFAULT):
    return Window.partitionBy(layout.key, BLOCK).orderBy(POS)


def block_window_reversed(layout: Layout = DEFAULT):
    return Window.partitionBy(layout.key, BLOCK).orderBy(F.col(POS).desc())


def join_per_city(df: DataFrame, per_city: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Bring one row per city to a blocked series.

    Joining on the city alone would put a hot city in one task, so the small side
    is first spread over the city's blocks and the join runs on both columns.
    """
    blocks = df.select(layout.key, BLOCK).distinct()
    return df.join(blocks.join(per_city, layout.key), [layout.key, BLOCK])


def last_rows(df: DataFrame, n: int, layout: Layout = DEFAULT) -> DataFrame:
    """The newest ``n`` rows of every city.

    Each time chunk is cut to its own newest ``n`` first, so the last step sees at
    most ``n`` rows per chunk of a hot city.
    """
    newest = [c.desc() for c in layout.order]
    seconds = F.unix_seconds(F.col(layout.time).cast("timestamp"))
    chunk = F.floor(seconds / layout.chunk_seconds)
    in_chunk = Window.partitionBy(layout.key, CHUNK).orderBy(*newest)
    in_city = Window.partitionBy(layout.key).orderBy(*newest)
    return (
        df.withColumn(CHUNK, chunk)
        .withColumn("_rank", F.row_number().over(in_chunk))
        .where(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(in_city))
        .where(F.col("_rank") <= n)
        .drop("_rank", CHUNK)
    )
