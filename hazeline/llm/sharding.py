"""Shards cut from a Hilbert curve over several metadata columns.

Every row becomes a cell of a small grid, one axis per column; cells are numbered along the
Hilbert curve, rows are put in the order of their cells, and the order is cut into runs of
equal row counts. Rows that are close in all columns then share a shard, and a shard's box
of cells lets a reader skip it (``manifest``, ``shards_for``).

Equal texts are a group: they take the cell of the group's smallest language and source, and
rows within a cell are ordered by size, text hashes and id. So a group lies together, where
only a cut between shards can part it, and a cell that holds a third of all rows is still
cut. The order is a range shuffle on keys that end in the id; places come from the
partitions' row counts, so no task sees more than its range, and no window runs over the
whole table.

Edge cases: a null text has size 1 and the hash of the empty string; null source and lang
are the empty string; repeated rows each get a slot of their own, rows that are alike in all
keys in any order; very long texts are hashed whole; an empty table gives an empty result;
other columns are not read.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm.common import text_or_empty
from hazeline.session import write_and_reread

#: Bits of each axis; three axes give 4,096 cells.
BITS = 4
SHARDS = 8
#: The metadata that span the grid.
AXES = ["size_cell", "lang_cell", "source_cell"]
#: Parts that the rows of one text are dealt to where they are joined.
SPREAD = 32
#: Rows of a partition that monotonically_increasing_id can number.
ROW_BITS = 33


def hilbert_index(axes: Sequence[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of a cell, given by whole numbers below ``2 ** bits``.

    Skilling's transform: from the highest bit down, an axis whose bit is set flips the
    lower bits of the first axis, else swaps them with it; then a Gray code over the axes,
    whose bits are interleaved.
    """
    n = len(axes)
    bit = lambda value, q: value.bitwiseAND(q) != 0

    def turn(x: Column, axis: Column, q: Column) -> Column:
        first, own, low = F.get(x, F.lit(0)), F.get(x, axis), q - 1
        swapped = first.bitwiseXOR(own).bitwiseAND(low)
        other = F.when(bit(own, q), own).otherwise(own.bitwiseXOR(swapped))
        new_first = F.when(bit(own, q), first.bitwiseXOR(low)).otherwise(first.bitwiseXOR(swapped))
        return F.transform(x, lambda v, i: F.when(i == 0, new_first).when(i == axis, other).otherwise(v))

    masks = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)])
    numbers = F.array(*[F.lit(i) for i in range(n)])
    start = F.array(*[a.cast("int") for a in axes])
    turned = F.aggregate(
        F.flatten(F.transform(masks, lambda q: F.transform(numbers, lambda i: F.struct(q.alias("q"), i.alias("i"))))),
        start,
        lambda x, step: turn(x, step["i"], step["q"]),
    )
    # prefix exclusive-or over the axes, then the parity of the last axis' higher bits on all
    gray = lambda x: F.transform(
        x, lambda v, i: F.aggregate(F.slice(x, F.lit(1), i + 1), F.lit(0), lambda a, b: a.bitwiseXOR(b))
    )
    flips = lambda x: F.aggregate(
        masks, F.lit(0), lambda t, q: F.when(bit(F.get(x, F.lit(n - 1)), q), t.bitwiseXOR(q - 1)).otherwise(t)
    )
    flipped = lambda x: _let(flips(x), lambda t: F.transform(x, lambda v: v.bitwiseXOR(t)))
    places = F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)])
    interleaved = lambda x: F.aggregate(
        F.flatten(F.transform(places, lambda b: F.transform(x, lambda v: F.getbit(v, b).cast("int")))),
        F.lit(0).cast("long"),
        lambda total, one: total * 2 + one,
    )
    return _let(_let(_let(turned, gray), flipped), interleaved)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def curve_table(spark: SparkSession) -> DataFrame:
    """The place of every cell on the curve: 2 ** (3 * BITS) rows whatever the input."""
    cells = spark.range(1 << (BITS * len(AXES))).select(
        *[F.shiftright("id", BITS * i).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int").alias(a) for i, a in enumerate(AXES)]
    )
    return cells.withColumn("curve", hilbert_index([F.col(a) for a in AXES]))


def size_cell(size: Column, bits: int = BITS) -> Column:
    """The power of two of a size, above 2 ** 4, held within the axis."""
    return F.least(F.greatest(F.floor(F.log2(size.cast("double"))) - 4, F.lit(0)), F.lit((1 << bits) - 1)).cast("int")


def name_cell(name: Column, bits: int = BITS) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(name, F.lit(""))), F.lit(1 << bits)).cast("int")


def ranked(df: DataFrame, *keys: str, label: str = "ranked") -> tuple[DataFrame, int]:
    """``place`` from 0 over the whole table in the order of the keys, and the row count.

    One range shuffle, kept as a table, whose row numbers tell each row's partition and
    place in it; only the partitions' row counts are gathered (one row a partition).
    """
    spark = df.sparkSession
    ordered = write_and_reread(df.orderBy(*keys).withColumn("_row", F.monotonically_increasing_id()), label)
    part = F.shiftright("_row", ROW_BITS)
    counts = sorted((r["p"], r["n"]) for r in ordered.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    before, offsets = 0, []
    for p, n in counts:
        offsets.append((p, before))
        before += n
    table = spark.createDataFrame(offsets, "_part long, _before long")
    placed = ordered.withColumn("_part", part).join(F.broadcast(table), "_part")
    within = F.col("_row").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.withColumn("place", F.col("_before") + within).drop("_row", "_part", "_before"), before


def _with_least_names(facts: DataFrame) -> DataFrame:
    """Rows of one text take the cells of its smallest (lang, source), so that they lie together.

    Only texts that several rows have are joined, each row of them in one of SPREAD parts,
    since one text may have a third of all rows.
    """
    text = ["size", "text_crc32", "text_key"]
    least = F.min(F.struct("lang", "source", "lang_cell", "source_cell")).alias("least")
    several = facts.groupBy(*text).agg(least, F.count("*").alias("n")).where(F.col("n") > 1)
    cells = several.select(*text, F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"), "least")
    dealt = facts.withColumn("part", F.pmod(F.xxhash64("doc_id", "lang", "source"), F.lit(SPREAD)).cast("int"))
    joined = dealt.join(cells, [*text, "part"], "left")
    own = {c: F.coalesce(F.col(f"least.{c}"), F.col(c)) for c in ("lang_cell", "source_cell")}
    return joined.withColumns(own).drop("part", "least", "lang", "source")


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every document with its cell axes, place on the curve, shard and slot; counts differ by one at most."""
    text = text_or_empty()
    facts = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        name_cell(F.col("source")).alias("source_cell"),
        name_cell(F.col("lang")).alias("lang_cell"),
    ).withColumn("size_cell", size_cell(F.col("size")))
    curve = _with_least_names(facts).join(F.broadcast(curve_table(docs.sparkSession)), AXES)
    placed, rows = ranked(curve, "curve", "size", "text_crc32", "text_key", "doc_id", label="shards")
    shard = F.expr(f"int(place * {shards} div {max(rows, 1)})")
    first = F.expr(f"(shard * {max(rows, 1)}L + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("place") - first)


def manifest(placed: DataFrame) -> DataFrame:
    """Each shard's rows, bytes and box of cells."""
    ends = [f(c).alias(f"{name}_{c}") for c in AXES for name, f in (("min", F.min), ("max", F.max))]
    return placed.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *ends)


def shards_for(boxes: DataFrame, **cells: tuple[int, int]) -> DataFrame:
    """The shards whose boxes meet the given ranges of cells, e.g. ``size_cell=(3, 5)``."""
    for name, (low, high) in cells.items():
        boxes = boxes.where((F.col(f"min_{name}") <= high) & (F.col(f"max_{name}") >= low))
    return boxes.select("shard")
