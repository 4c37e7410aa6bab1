"""Benchmark decontamination: find, and remove, benchmark passages in documents.

The benchmark's windows are a hash set on every executor when it is small (its size is
counted, not assumed) and a shuffled table otherwise. Scanning every window of every
document would hash each word ten times; instead each document is cut at fixed places into
runs of half a window's length, one of which lies inside any window wherever that begins.
Only around runs that the benchmark has are full windows looked up, by their words.

Edge cases: null texts and texts without words have no words, no hits and the digest of the
empty string; items without words have no window; repeated item ids with different texts
count as one item; rows with the same doc_id and text give equal rows; rows that share a
doc_id but not the text are kept apart; very long texts are read whole, once, and only the words around
runs that the benchmark has move; other columns are not read, whatever their names.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import all_matches, apart, ascii_lower, sha256, text_or_empty

#: What stands between words, after lower-casing: ASCII other than digits and a-z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word in a text as it stands.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
#: Most rows of a benchmark table that are sent to every executor; about 20 MB.
BROADCAST_ROWS = 200_000
#: Stands between the words of a key; it is in no word.
GAP = " "


def words_of(text: Column) -> Column:
    """The words of a text; splitting between them is many times faster than extracting them."""
    return F.array_remove(F.split(ascii_lower(text), BETWEEN, -1), "")


def _key(words: Column, start: Column, width: Column | int) -> Column:
    """``width`` words from a 0-based place, as one string."""
    return F.array_join(F.slice(words, start + 1, width), GAP)


def run_width(window: int) -> int:
    """The longest run that a cut at its multiples always leaves whole inside a window."""
    return (window + 1) // 2


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct ``(width, words, item_id)``; an item of fewer words is one window."""
    items = benchmark.select("item_id", words_of(text_or_empty()).alias("words")).where(F.size("words") > 0)
    width = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(0), F.size("words") - width)
    return (
        items.select("item_id", "words", width.alias("width"), F.explode(starts).alias("at"))
        .select("width", _key(F.col("words"), F.col("at"), F.col("width")).alias("words"), "item_id")
        .distinct()
    )


def _sent(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _runs(grams: DataFrame, widths: list[int]) -> DataFrame:
    """``width, run``: hashes of the runs inside the windows of each width."""
    def of(width):
        run = run_width(width)
        inside = F.sequence(F.lit(0), F.lit(width - run))
        own = grams.where(F.col("width") == width)
        return own.select("width", F.explode(F.transform(inside, lambda i: _key(F.split("words", GAP), i, run))).alias("run"))

    return reduce(DataFrame.unionByName, map(of, widths)).select("width", F.xxhash64("run").alias("run")).distinct()


def _cuts(widths: list[int]) -> Column:
    """``width, at, run`` of the fixed runs of a document, for all widths."""
    words = F.col("words")

    def of(width):
        run = run_width(width)
        last = F.floor((F.size(words) - run) / run).cast("int")
        runs = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(F.lit(width).alias("width"), (i * run).alias("at"), F.xxhash64(_key(words, i * run, run)).alias("run")),
        )
        none = F.array().cast("array<struct<width: int, at: int, run: bigint>>")
        return F.when(F.size(words) >= run, runs).otherwise(none)

    return F.concat(*map(of, widths))


def versions(docs: DataFrame) -> DataFrame:
    """``doc_id, version, text``: the hash of the text keeps rows apart that share an id."""
    text = text_or_empty()
    return docs.select(F.col("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))


def _same(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Joins on id and version, ids that are null included."""
    right = right.withColumnsRenamed({"doc_id": "_doc_id", "version": "_version"})
    on = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("version") == F.col("_version"))
    return left.join(right, on, how).drop("_doc_id", "_version")


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, version, hit_at, items`` of the documents that hold a window.

    ``hit_at`` has the 0-based places of hit words, ``items`` the ids as strings, both sorted.
    """
    grams = windows_of(benchmark, window)
    sizes = {r["width"]: r["count"] for r in grams.groupBy("width").count().collect()}  # `window` rows at most
    rows = sum(sizes.values())
    texts = versions(docs)
    if not sizes:
        nothing = [F.array().cast(f"array<{kind}>").alias(name) for name, kind in (("hit_at", "int"), ("items", "string"))]
        return texts.select("doc_id", "version", *nothing).where(F.lit(False))
    widths = sorted(sizes)
    words = texts.select("doc_id", "version", words_of(F.col("text")).alias("words"))
    # a run takes the words around it along, as many as the windows that hold it have, so that
    # the text is read once and is not shuffled
    first = F.greatest(F.lit(0), F.col("at") + F.floor((F.col("width") + 1) / 2).cast("int") - F.col("width"))
    near = F.slice("words", first + 1, F.col("at") - first + F.col("width"))
    runs = (
        words.select("doc_id", "version", "words", F.inline(_cuts(widths)))
        .select("doc_id", "version", "width", "run", first.alias("first"), (F.col("at") - first).alias("more"), near.alias("near"))
        .join(_sent(_runs(grams, widths), rows * run_width(window)), ["width", "run"], "left_semi")
    )
    window_at = lambda i: F.struct((F.col("first") + i).alias("at"), _key(F.col("near"), i, F.col("width")).alias("words"))
    windows = runs.select("doc_id", "version", "width", F.inline(F.transform(F.sequence(F.lit(0), F.col("more")), window_at)))
    by_words = grams.groupBy("width", "words").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    verified = windows.join(_sent(by_words, rows), ["width", "words"])
    inside = F.sequence(F.col("at"), F.col("at") + F.col("width") - 1)
    united = lambda column: F.array_sort(F.array_distinct(F.flatten(F.collect_set(column))))
    return verified.groupBy("doc_id", "version").agg(united(inside).alias("hit_at"), united("items").alias("items"))


def scanned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every document with its word count, hit words, items and verdict."""
    base = versions(docs).select("doc_id", "version", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    both = _same(base, hits(docs, benchmark, window), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce(F.size("hit_at"), F.lit(0)).cast("long")
    return both.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        sha256(F.array_join(items, ",")).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW) -> DataFrame:
    """The documents without benchmark passages; all their columns stay.

    ``remove="documents"`` leaves out every document with a hit. ``remove="spans"`` keeps
    them and puts a line break in place of each run of hit words.
    """
    doc_id, version, hit_at, at = apart(docs, "_doc_id", "_version", "_hit_at", "_at")
    found = hits(docs, benchmark, window).select(
        F.col("doc_id").alias(doc_id), F.col("version").alias(version), F.col("hit_at").alias(hit_at)
    )
    on = F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.xxhash64(text_or_empty()) == F.col(version))
    if remove == "documents":
        return docs.join(found, on, "left_anti")
    if remove != "spans":
        raise ValueError(f"remove is 'documents' or 'spans', not {remove!r}")
    # words and what stands between them alternate: gap, word, gap, ..., word, gap
    gaps, words = F.split("text", WORD_ANY_CASE, -1), all_matches(F.col("text"), WORD_ANY_CASE)
    joined = docs.join(found, on, "left").withColumn(at, _marks(F.col(hit_at), F.size(gaps)))
    kept = F.transform(
        gaps,
        lambda gap, i: F.concat(
            F.when((i > 0) & F.get(F.col(at), i - 1) & F.get(F.col(at), i), F.lit("")).otherwise(gap),
            F.when(i >= F.size(gaps) - 1, F.lit(""))
            .when(~F.get(F.col(at), i), F.get(words, i))
            .when((i > 0) & F.get(F.col(at), F.greatest(i - 1, F.lit(0))), F.lit(""))
            .otherwise(F.lit("\n")),
        ),
    )
    text = F.when(F.col(hit_at).isNull(), F.col("text")).otherwise(F.array_join(kept, ""))
    columns = [text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns)


def _marks(places: Column, count: Column) -> Column:
    """Whether each number below ``count`` is among the sorted places: the runs of others between them, put together."""
    before = F.concat(F.array(F.lit(-1)), places)
    after = F.concat(places, F.array(count))
    gaps = F.zip_with(before, after, lambda a, b: F.array_repeat(F.lit(False), b - a - 1))
    ends = F.transform(gaps, lambda run, i: F.when(i < F.size(places), F.concat(run, F.array(F.lit(True)))).otherwise(run))
    return F.flatten(ends)
