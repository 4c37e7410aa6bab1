"""Vendor payloads: nested JSON to flat, scored readings."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.aqi import with_aqi
from hazeline.functions.text import strip_prefixes
from hazeline.operators.projection import select_present
from hazeline.schemas import CITY, PAYLOAD, POLLUTANTS, TIME


#: Holds the text of a record that is no document of the schema.
REJECTED = "_rejected"


def payload_schema(with_city: bool = True, rejected: str | None = None):
    """Schema of payload files; ``city`` comes from the folder or the document."""
    schema = type(PAYLOAD)(list(PAYLOAD.fields))
    schema = schema.add(CITY, "string") if with_city else schema
    return schema.add(rejected, "string") if rejected else schema


def json_reader(reader, folder: str) -> DataFrame:
    """Payload files through a batch or stream reader, malformed records as text in REJECTED."""
    return reader.schema(payload_schema(rejected=REJECTED)).option("columnNameOfCorruptRecord", REJECTED).json(folder)


def accepted(payloads: DataFrame) -> DataFrame:
    return payloads.where(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected(payloads: DataFrame) -> DataFrame:
    """The malformed records, with the city as far as it could be read and the file that each came from."""
    found = payloads.where(F.col(REJECTED).isNotNull())
    return found.select(CITY, F.col(REJECTED).alias("record"), F.input_file_name().alias("file"))


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The documents of payload files; malformed records are left to :func:`rejected`."""
    return accepted(json_reader(spark.read, path))


def write_payloads(readings: DataFrame, path: str) -> None:
    """One JSON document per reading, as a vendor's files have them."""
    readings.select(CITY, F.array(_entry(None)).alias("list")).write.mode("append").json(path)


def parse_payloads(df: DataFrame, column: str) -> DataFrame:
    """Payload documents held as text in a column."""
    return df.withColumn("_doc", F.from_json(column, PAYLOAD)).select(*df.columns, "_doc.list")


def flatten(payloads: DataFrame) -> DataFrame:
    """One row per payload entry, with dotted names as a normaliser would give."""
    kept = [c for c in payloads.columns if c != "list"]
    entries = payloads.select(*kept, F.inline("list"))
    nested = [F.col("main.aqi").alias("main.aqi")]
    nested += [F.col(f"components.{name}").alias(f"components.{name}") for name in POLLUTANTS]
    return entries.select(*kept, *nested, "dt")


def clean_names(flat: DataFrame) -> DataFrame:
    """Strip the ``main.`` and ``components.`` parts of column names."""
    return flat.withColumnsRenamed(dict(zip(flat.columns, strip_prefixes(flat.columns))))


def to_readings(payloads: DataFrame, time: Column | None = None) -> DataFrame:
    """Flatten, stamp, project and score. Works on batches and streams alike."""
    stamp = F.timestamp_seconds("dt") if time is None else time
    return with_aqi(select_present(clean_names(flatten(payloads)).withColumn(TIME, stamp)))


def _entry(vendor_index: Column | None) -> Column:
    vendor = F.lit(1) if vendor_index is None else vendor_index
    return F.struct(
        F.struct(vendor.cast("int").alias("aqi")).alias("main"),
        F.struct(*POLLUTANTS).alias("components"),
        F.unix_seconds(F.col(TIME).cast("timestamp")).alias("dt"),
    )


def as_documents(readings: DataFrame, vendor_index: Column | None = None) -> DataFrame:
    """The reverse: one payload document per reading, as ``city, payload`` text."""
    return readings.select(CITY, F.to_json(F.struct(F.array(_entry(vendor_index)).alias("list"))).alias("payload"))
