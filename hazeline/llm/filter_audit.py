"""Audit of how filters interact: what each removes in every order, by incremental retraction.

All files are processed as micro-batches of an available-now stream. A document's mask says
which of the filters A to D it fails; filter E, a text that a smaller id has too, depends on
documents that may come later. So Spark's state store keeps, for each text seen, the
smallest id so far and the masks counted for it. A smaller id retracts what was counted for
the earlier one, as a negative amount, and counts it again with E failed. The amounts are
appended to a table, whose sums by part and mask are the counters that all figures follow
from: they do not depend on how rows fall into files and micro-batches.

State is keyed by buckets of text digests, some hundreds of texts each, because a call of
Python for every single text costs more than its work. Copies of a text are combined in the
tasks that read them, so that a text with a third of all rows sends few rows to its bucket.

Edge cases: a null text is empty; an empty text fails A alone, and E where a smaller id has
one too; a null lang is the part named by the empty string; rows of one text with its
smallest id, repeated ones included, all pass E; a null id is no smaller or larger than any,
passes E and has no labels; several labels of one id count as 1 where any is 1; very long
texts are read whole; an empty table gives no rows; other columns are not read.
"""

import hashlib
import itertools
import pickle
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm.common import text_or_empty
from hazeline.session import scratch_path, write_and_reread

FILTERS = "ABCDE"
#: Bits of a mask, in the order of FILTERS; the labels follow.
E_FAILS, GOOD, TOXIC = 16, 32, 64
NOT_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
SIGNS = re.compile(r"[#$%&*|]")
#: Texts of a state bucket, on average, and micro-batches that the files are dealt to.
BUCKET, MICRO_BATCHES = 512, 4

ROW = "bucket long, digest binary, id_known boolean, doc_id long, part string, bits int, n long"


def failed_filters(text: str) -> int:
    """Mask of the filters A to D that a text fails."""
    raw = text.encode()
    words = raw.split()  # of bytes: only ASCII white space counts
    upper = len(raw.translate(None, NOT_UPPER))
    return (
        (len(words) < 200)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * upper > 3 * len(text)) << 2
        | (SIGNS.search(text) is not None) << 3
    )


def _masked(buckets: int):
    """Texts to digests and masks; equal rows of a batch become one."""

    def run(batches):
        for batch in batches:
            rows = Counter()
            for no_id, doc_id, part, text in zip(batch["no_id"], batch["doc_id"], batch["part"], batch["text"]):
                digest = hashlib.blake2b(text.encode(), digest_size=16).digest()
                rows[(digest, not no_id, doc_id, part, failed_filters(text))] += 1
            yield pd.DataFrame(
                [(int.from_bytes(k[0][:7]) % buckets, *k, n) for k, n in rows.items()],
                columns=["bucket", "digest", "id_known", "doc_id", "part", "bits", "n"],
            )

    return run


def _combined(batches):
    """Copies of a text in a batch: those of its smallest id, and one sum of all others.

    The others fail E whatever follows, which ``bits`` says already.
    """
    for batch in batches:
        least, rows = {}, Counter()
        columns = [batch[c].tolist() for c in ("bucket", "digest", "id_known", "doc_id", "part", "bits", "n")]
        for _, digest, known, doc_id, *_ in zip(*columns):
            if known and doc_id < least.get(digest, doc_id + 1):
                least[digest] = doc_id
        for bucket, digest, known, doc_id, part, bits, n in zip(*columns):
            if known and doc_id != least[digest]:
                doc_id, bits = least[digest], bits | E_FAILS
            rows[(bucket, digest, known, doc_id, part, bits)] += n
        yield pd.DataFrame([(*k, n) for k, n in rows.items()], columns=list(batch.columns))


def _retracting(key, batches, state):
    """Amounts to add to the counters for the new rows of a bucket's texts.

    The state maps a digest to its smallest id and what is counted for that as passing E.
    """
    texts = pickle.loads(state.get[0]) if state.exists else {}
    amounts = Counter()
    for batch in batches:
        columns = [batch[c].tolist() for c in ("digest", "id_known", "doc_id", "part", "bits", "n")]
        for digest, known, doc_id, part, bits, n in zip(*columns):
            if not known or bits & E_FAILS:
                amounts[(part, bits)] += n
                if not known:
                    continue
            least, passing = texts.get(digest, (None, {}))
            if least is None or doc_id < least:
                for (p, b), count in passing.items():
                    amounts[(p, b)] -= count
                    amounts[(p, b | E_FAILS)] += count
                least, passing = doc_id, {}
                texts[digest] = (least, passing)
            if not bits & E_FAILS:
                if doc_id == least:
                    passing[(part, bits)] = passing.get((part, bits), 0) + n
                    amounts[(part, bits)] += n
                else:
                    amounts[(part, bits | E_FAILS)] += n
    state.update((pickle.dumps(texts),))
    yield pd.DataFrame([(p, b, n) for (p, b), n in amounts.items() if n], columns=["part", "bits", "n"])


def amounts(stream: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """The stream of signed amounts ``part, bits, n`` of a stream of documents."""
    one = lambda c: F.max((F.col(c) == 1).cast("int"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    marks = write_and_reread(marks.where(F.col("doc_id").isNotNull()), "marks")
    rows = stream.select(
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text_or_empty().alias("text"),
    )
    masked = rows.mapInPandas(_masked(buckets), ROW)
    marked = masked.join(marks, "doc_id", "left")
    bit = lambda c, value: F.when(F.col("id_known") & (F.col(c) == 1), F.lit(value)).otherwise(0)
    marked = marked.withColumn("bits", F.col("bits") + bit("good", GOOD) + bit("toxic", TOXIC))
    combined = marked.select("bucket", "digest", "id_known", "doc_id", "part", "bits", "n").mapInPandas(_combined, ROW)
    return combined.groupBy("bucket").applyInPandasWithState(
        _retracting, "part string, bits int, n long", "texts binary", "append", "NoTimeout"
    )


def counted(spark: SparkSession, path: str, labels: DataFrame, batches: int = MICRO_BATCHES) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the set of filters they fail.

    ``path`` is a Parquet table of documents, each file of which is read once.
    """
    docs = spark.read.parquet(path)
    buckets = max(1, -(-docs.count() // BUCKET))
    per_batch = max(1, -(-len(docs.inputFiles()) // batches))
    # a pattern, since a file stream takes a plain path for a folder
    files = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", per_batch).parquet(files)
    out = scratch_path(spark, "amounts")
    (
        amounts(stream, labels, buckets)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", f"{out}-log")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    added = spark.read.schema("part string, bits int, n long").parquet(out)
    having = lambda bit: F.sum(F.when(F.col("bits").bitwiseAND(bit) > 0, F.col("n")).otherwise(0))
    sums = added.groupBy("part", F.col("bits").bitwiseAND(GOOD - 1).alias("mask")).agg(
        F.sum("n").alias("n"), having(GOOD).alias("good"), having(TOXIC).alias("toxic")
    )
    return sums.where(F.col("n") > 0)


def orders_of(counts: DataFrame) -> DataFrame:
    """The audit of every order of the filters, from the counters: 600 rows a part."""
    orders = F.array(*[F.lit("".join(p)) for p in itertools.permutations(FILTERS)])
    bit = lambda letter: F.expr(f"shiftleft(1, ascii({letter}) - ascii('A'))")
    mask, failing, n = F.col("mask"), F.col("mask").bitwiseAND(F.col("bit")) > 0, F.col("n")
    steps = (
        counts.withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("letter", F.expr("substring(filter_order, step, 1)"))
        .withColumn("bit", bit("letter"))
        .withColumn("before", F.expr(
            "aggregate(filter(split(substring(filter_order, 1, step - 1), ''), l -> l <> ''), 0, "
            "(a, l) -> a + shiftleft(1, ascii(l) - ascii('A')))"
        ))
    )
    reached = mask.bitwiseAND(F.col("before")) == 0
    total = lambda condition, what=n: F.coalesce(F.sum(F.when(condition, what)), F.lit(0)).cast("long")
    # of a document's failing filters each is the first one in the same number of orders
    share = n * F.lit(120) / F.bit_count("mask")
    return steps.groupBy("part", "filter_order", "step").agg(
        total(reached & ~failing).alias("kept"),
        total(reached & failing).alias("removed"),
        total(~reached & failing).alias("redundant"),
        total(mask == F.col("bit")).alias("unique_fails"),
        total(reached & failing, F.col("good")).alias("good_lost"),
        total(reached & failing, F.col("toxic")).alias("toxic_lost"),
        total(failing, share).alias("shapley"),
    )


def audited(spark: SparkSession, path: str, labels: DataFrame, batches: int = MICRO_BATCHES) -> DataFrame:
    """What every filter removes at every step of every order, by part."""
    counts = write_and_reread(counted(spark, path, labels, batches), "counters")
    return orders_of(counts)
