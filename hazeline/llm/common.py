"""What several operators share: reading tables, plain columns, hash splits."""

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows whose remainder is 0 are held out of every fit.
FOLDS = 5
#: Keys whose facts are sent to every executor, at most.
HOT_KEYS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves no remainder by FOLDS; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))) % FOLDS == 0


def id_text(doc_id: str = "doc_id") -> Column:
    """The id as text for pandas, which would make whole numbers with nulls floats."""
    return F.col(f"`{doc_id}`").cast("string").alias("doc_id")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def all_matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), 0)


def row_keys() -> dict[str, Column]:
    """Two columns that tell rows of one id, or without one, apart by plain equality.

    ``id_key`` is never null; ``version`` hashes the text and whether there is an id.
    """
    return {
        "id_key": F.coalesce("doc_id", F.lit(0)).cast("long"),
        "version": F.xxhash64(F.col("doc_id").isNull(), text_or_empty()),
    }


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, id_key, version, text`` with null texts empty."""
    keys = [key.alias(name) for name, key in row_keys().items()]
    return docs.select("doc_id", *keys, text_or_empty().alias("text"))


def apart(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as tell it from all columns of a table."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def attached(rows: DataFrame, facts: DataFrame, keys: list[str], size: str, total: int, how: str = "inner", most_hot: int = HOT_KEYS) -> DataFrame:
    """``rows`` joined with the one row of ``facts`` for their keys, in even tasks however often a key occurs.

    ``size`` is a column of ``facts``, left out of the result, that counts a key's rows; ``total`` is no less than the
    number of all rows. Less than ``most_hot`` keys can have more than a ``most_hot``-th of all rows. Their facts are
    sent to every executor and their rows stay where they are; only the other rows are shuffled. No more than ``HOT_KEYS``
    rows are no burden for one task; they are joined as they are, which keeps the plans of many rounds small.
    """
    if total <= HOT_KEYS:
        return rows.join(facts.drop(size), keys, how)
    limit = -(-total // most_hot)
    hot, cold = facts.where(F.col(size) > limit), facts.where(F.col(size) <= limit).drop(size)
    marked = rows.join(F.broadcast(hot), keys, "left")
    known = marked.where(F.col(size).isNotNull()).drop(size)
    others = marked.where(F.col(size).isNull()).select(*rows.columns)
    return known.unionByName(others.join(cold, keys, how))


def in_parts(rows: DataFrame, table: DataFrame, keys: list[str], spread: str, counted: DataFrame) -> DataFrame:
    """``rows`` joined with ``table`` on keys, frequent ones in parts drawn by a hash of the column ``spread``.

    Unlike ``attached`` nothing large is sent around: a frequent key's row of ``table`` is copied to its parts.
    ``counted`` is a written table with the keys of all rows.
    """
    limit = max(1, -(-counted.count() // HOT_KEYS))
    parts = F.ceil(F.col("_size") / limit).cast("int").alias("_parts")
    often = counted.groupBy(*keys).agg(F.count("*").alias("_size")).where(F.col("_size") > limit).select(*keys, parts)
    left = rows.join(F.broadcast(often), keys, "left")
    left = left.withColumn("_part", F.coalesce(F.pmod(F.xxhash64(spread), "_parts"), F.lit(0))).drop("_parts")
    right = table.join(F.broadcast(often), keys, "left")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1)).cast("long") - 1))
    right = right.withColumn("_part", every).drop("_parts")
    return left.join(right, [*keys, "_part"]).drop("_part")
