"""Ranked lexical search by Block-Max MaxScore over shards of an inverted index.

The index is a table. Tasks that read documents cut them into shards of bounded size and
write, for each term of a shard, its postings in compressed blocks: document numbers as
differences and occurrences, each in the fewest bytes that hold them. A block keeps the pairs
of occurrences and document length that no other pair of it surpasses; from these its best
weight follows exactly for any collection statistics, so the index needs none.

A search goes over the shards as groups. In a shard, the best weight of a term's blocks is
its global bound. Terms are put in order of that bound; those that together cannot reach the
score of the worst of the best documents so far are non-essential. Documents of the essential
lists are candidates. A candidate whose score so far and the block maxima of the
non-essential terms fall short is rejected before those blocks are decompressed; of the
others the blocks are decompressed term by term, with a new look at the bound each time. Shards
are gone through in windows of document numbers, in which all of this is done for many
documents at once. Each shard gives a heap of its best documents per item, and the heaps
are merged by score and id.

The terms of the items are on every executor, at most TERMS_AT_ONCE of them; items with more
terms than that together are searched in several passes, each over all documents.

Edge cases: a null text has no term; documents and items without terms match nothing; texts
of one item id belong to one item, equal rows of items count once; a null item id is an item
of its own; every row of documents is a document, so repeated ones take a rank each; equal
scores are ordered by id, a null id last; a term that is repeated in an item counts as often;
very long texts are read whole; empty tables give no rows; other columns are not read.
"""

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hazeline.llm.common import text_or_empty
from hazeline.session import write_and_reread

#: A-Z to a-z, all other ASCII but digits and letters to blanks; bytes of longer characters stay.
TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
#: Documents of a shard, at most, and postings of a block.
SHARD, POSTINGS = 32_768, 128
#: Documents of the first window of a shard; the next ones are twice as long each, up to a limit.
FIRST_WINDOW, LAST_WINDOW = 512, 8192
TERMS_AT_ONCE = 300_000
TOP = 20
#: Fixed values of the ranking: hundredths of length normalisation, and its unit and slope.
B, UNIT, SLOPE, SATURATION = 25, 1000, 12, 1_000_000_000

INDEX = "shard string, term string, at binary, ends binary, best binary, n_documents long, n_terms long"


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(TERM_BYTES).split()


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes a value that hold them all, after a byte that says how many."""
    most = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 256**w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{data[0]}", offset=1).astype(np.int64)


def _unsurpassed(tf: np.ndarray, lengths: np.ndarray) -> list[int]:
    """Places of the pairs to which no other has as many occurrences in as short a document."""
    kept, most = [], 0
    for i in np.lexsort((-tf, lengths)):
        if tf[i] > most:
            kept.append(i)
            most = tf[i]
    return kept


def _blocks(numbers: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """A term's postings as compressed blocks, the blocks' table and their best pairs.

    The table has, for each block: first and last document number, end of its two parts in
    the data, and end of its pairs.
    """
    data, table, pairs = bytearray(), [], []
    for at in range(0, len(numbers), POSTINGS):
        own, counts = numbers[at : at + POSTINGS], tf[at : at + POSTINGS]
        data += packed(np.diff(own))
        middle = len(data)
        data += packed(counts)
        best = _unsurpassed(counts, lengths[at : at + POSTINGS])
        pairs += [(counts[i], lengths[at + i]) for i in best]
        table.append((own[0], own[-1], middle, len(data), len(pairs)))
    return bytes(data), np.array(table, dtype="<i8").tobytes(), np.array(pairs, dtype="<i8").tobytes()


def _shard_rows(ids: list, lengths: list, places: list, found: list, counts: list, names: dict) -> pd.DataFrame:
    """The index rows of one shard: its documents, then its terms."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))  # numbers follow ids
    number = np.empty(len(ids), dtype=np.int64)
    number[order] = np.arange(len(ids))
    long = np.array(lengths, dtype=np.int64)[order]
    sizes = [len(f) for f in found]
    doc = np.repeat(number, sizes) if ids else np.zeros(0, dtype=np.int64)
    term, tf = (np.concatenate([*p, np.zeros(0)]).astype(np.int64) for p in (found, counts))
    by_term = np.lexsort((doc, term))
    doc, term, tf = doc[by_term], term[by_term], tf[by_term]
    known = np.array([ids[i] if ids[i] is not None else 0 for i in order], dtype="<i8")
    no_id = np.array([ids[i] is None for i in order], dtype=np.uint8)
    shard = f"{places[0]}"
    rows = [(shard, None, known.tobytes(), no_id.tobytes(), long.astype("<i8").tobytes(), int((long > 0).sum()), int(long.sum()))]
    starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else []
    for start, end in zip(starts, [*starts[1:], len(term)]):
        own = doc[start:end]
        rows.append((shard, names[term[start]], *_blocks(own, tf[start:end], long[own]), end - start, int(tf[start:end].sum())))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in INDEX.split(", ")])


def indexed(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """The inverted index of the documents for the terms of a vocabulary.

    A row is a term of a shard, or, with a null term, the shard's documents: their ids and
    lengths in terms. ``n_documents`` and ``n_terms`` give the row's documents and occurrences;
    for the shard as a whole documents without terms are left out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most TERMS_AT_ONCE

    def run(batches):
        import uuid

        names = sent.value
        number = {t.encode(): i for i, t in enumerate(names)}.get
        ids, lengths, found, counts = [], [], [], []
        for batch in batches:
            for no_id, doc_id, text in zip(batch["no_id"].tolist(), batch["doc_id"].tolist(), batch["text"]):
                words = terms_of(text)
                known = [i for i in map(number, words) if i is not None]
                own, tf = np.unique(np.array(known, dtype=np.int64), return_counts=True)
                ids.append(None if no_id else doc_id)
                lengths.append(len(words))
                found.append(own)
                counts.append(tf)
                if len(ids) >= SHARD:
                    yield _shard_rows(ids, lengths, [uuid.uuid4().hex], found, counts, names)
                    ids, lengths, found, counts = [], [], [], []
        if ids:
            yield _shard_rows(ids, lengths, [uuid.uuid4().hex], found, counts, names)

    rows = docs.select(
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
        text_or_empty().alias("text"),
    )
    return rows.mapInPandas(run, INDEX)


@dataclass(frozen=True)
class Statistics:
    """Documents with a term, terms of all documents, and documents by term."""

    documents: int
    terms: int
    frequency: dict

    def weight(self, term: str) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * self.frequency.get(term, 0) + 1)))

    def share(self, tf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What a term's weight is multiplied with: more for more occurrences, less for longer documents."""
        norm = 100 - B + (B * lengths * self.documents) // max(self.terms, 1)
        return (SATURATION * tf) // (UNIT * tf + SLOPE * norm)


def statistics(index: DataFrame) -> Statistics:
    """Sums over the index: one row, and one row a term of the vocabulary, whose size is bounded."""
    sums = index.groupBy("term").agg(F.sum("n_documents").alias("d"), F.sum("n_terms").alias("t")).collect()
    whole = next((r for r in sums if r["term"] is None), None)
    return Statistics(
        whole["d"] if whole else 0, whole["t"] if whole else 0, {r["term"]: r["d"] for r in sums if r["term"] is not None}
    )


class _List:
    """A term's postings in one shard: blocks that are decompressed when asked for."""

    def __init__(self, data: bytes, table: bytes, pairs: bytes, weight: int, stats: Statistics, lengths: np.ndarray):
        self.data, self.weight, self.stats, self.lengths = data, weight, stats, lengths
        table = np.frombuffer(table, dtype="<i8").reshape(-1, 5)
        pairs = np.frombuffer(pairs, dtype="<i8").reshape(-1, 2)
        self.first, self.last, self.middle, self.end = table[:, 0], table[:, 1], table[:, 2], table[:, 3]
        best = weight * stats.share(pairs[:, 0], pairs[:, 1])
        self.block_max = np.maximum.reduceat(best, np.r_[0, table[:-1, 4]])
        self.bound = int(self.block_max.max())
        self.opened = {}

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Document numbers and scores of a block, decompressed."""
        if i not in self.opened:
            at = self.end[i - 1] if i else 0
            steps, tf = unpacked(self.data[at : self.middle[i]]), unpacked(self.data[self.middle[i] : self.end[i]])
            numbers = self.first[i] + np.r_[0, np.cumsum(steps)]
            self.opened[i] = numbers, self.weight * self.stats.share(tf, self.lengths[numbers])
        return self.opened[i]

    def blocks_in(self, low: int, high: int) -> range:
        return range(int(np.searchsorted(self.last, low)), int(np.searchsorted(self.first, high)))

    def bounds(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block each document number falls into, and that block's best score; 0 between blocks."""
        block = np.searchsorted(self.last, numbers)
        inside = np.minimum(block, len(self.last) - 1)
        hit = (block < len(self.last)) & (self.first[inside] <= numbers)
        return inside, np.where(hit, self.block_max[inside], 0)


def best_of_shard(lists: list[tuple[_List, int]], size: int, top: int = TOP) -> list[tuple[int, int]]:
    """``(score, number)`` of the ``top`` highest scores above 0, smaller numbers first in ties.

    ``lists`` has each term's postings and how often the item repeats the term.
    """
    lists = sorted(lists, key=lambda own: own[0].bound * own[1])
    bounds = np.cumsum([own.bound * times for own, times in lists])
    heap: list[tuple[int, int]] = []  # best first
    low, window = 0, FIRST_WINDOW
    while low < size and lists:
        high = min(size, low + window)
        least = heap[-1][0] if len(heap) == top else 0
        # documents come in the order of numbers, so an equal score loses
        essential = int(np.searchsorted(bounds, least, side="right"))
        if essential == len(lists):
            break
        scores, met = np.zeros(high - low, dtype=np.int64), np.zeros(high - low, dtype=bool)
        for own, times in lists[essential:]:
            for i in own.blocks_in(low, high):
                numbers, values = own.block(i)
                inside = (numbers >= low) & (numbers < high)
                scores[numbers[inside] - low] += times * values[inside]
                met[numbers[inside] - low] = True
        candidates = np.flatnonzero(met) + low
        partial = scores[candidates - low]
        rest = lists[:essential]
        places = [own.bounds(candidates) for own, _ in rest]
        ahead = np.zeros(len(candidates), dtype=np.int64)
        for (_, best), (_, times) in zip(places, rest):
            ahead += times * best
        alive = partial + ahead > least
        for (own, times), (block, best) in reversed(list(zip(rest, places))):
            ahead -= times * best
            wanted = alive & (best > 0)
            for i in np.unique(block[wanted]):
                numbers, values = own.block(int(i))
                ours = np.flatnonzero(wanted & (block == i))
                at = np.minimum(np.searchsorted(numbers, candidates[ours]), len(numbers) - 1)
                hit = numbers[at] == candidates[ours]
                partial[ours[hit]] += times * values[at[hit]]
            alive &= partial + ahead > least
        good = np.flatnonzero(alive & (partial > 0))
        if len(good) > top:
            good = good[np.lexsort((candidates[good], -partial[good]))[:top]]
        heap += [(int(partial[i]), int(candidates[i])) for i in good]
        heap = sorted(heap, key=lambda entry: (-entry[0], entry[1]))[:top]
        low, window = high, min(2 * window, LAST_WINDOW)
    return heap


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, no_item, term, times`` of every item: terms with their repetitions."""

    def run(batches):
        for batch in batches:
            rows = []
            for no_item, item_id, text in zip(batch["no_item"], batch["item_id"], batch["text"]):
                rows += [(no_item, item_id, t.decode(), n) for t, n in Counter(terms_of(text)).items()]
            yield pd.DataFrame(rows, columns=["no_item", "item_id", "term", "times"])

    distinct = items.select("item_id", text_or_empty().alias("text")).distinct()
    rows = distinct.select(
        F.col("item_id").isNull().alias("no_item"), F.coalesce(F.col("item_id").cast("long"), F.lit(0)).alias("item_id"), "text"
    )
    counted = rows.mapInPandas(run, "no_item boolean, item_id long, term string, times long")
    return counted.groupBy("no_item", "item_id", "term").agg(F.sum("times").alias("times"))


def _passes(terms: DataFrame) -> list[list]:
    """The items' terms in parts of at most TERMS_AT_ONCE, whole items each (one may be larger)."""
    sizes = terms.agg(F.count("*").alias("n")).first()["n"]
    parts = -(-2 * sizes // TERMS_AT_ONCE) if sizes > TERMS_AT_ONCE else 1
    part = F.pmod(F.xxhash64("no_item", "item_id"), F.lit(parts))
    return [terms.where(part == i).collect() for i in range(parts)] if sizes else []


def _searched(docs: DataFrame, wanted: list, top: int) -> DataFrame:
    """``no_item, item_id, score, no_id, doc_id``: the heaps of all shards for some items."""
    spark = docs.sparkSession
    index = write_and_reread(indexed(docs, sorted({r["term"] for r in wanted})), "index")
    items: dict = {}
    for row in wanted:
        items.setdefault((row["no_item"], row["item_id"]), []).append((row["term"], row["times"]))
    sent = spark.sparkContext.broadcast((statistics(index), items))

    def run(shard: pd.DataFrame) -> pd.DataFrame:
        stats, items = sent.value
        documents = shard[shard["term"].isna()].iloc[0]
        ids, no_id = np.frombuffer(documents["at"], dtype="<i8"), np.frombuffer(documents["ends"], dtype=np.uint8)
        lengths = np.frombuffer(documents["best"], dtype="<i8")
        lists, out = {}, []
        for term, at, ends, best in zip(shard["term"], shard["at"], shard["ends"], shard["best"]):
            if term is not None:
                lists[term] = _List(at, ends, best, stats.weight(term), stats, lengths)
        for (no_item, item_id), terms in items.items():
            own = [(lists[t], times) for t, times in terms if t in lists]
            for score, number in best_of_shard(own, len(ids), top):
                out.append((no_item, item_id, score, bool(no_id[number]), ids[number]))
        return pd.DataFrame(out, columns=["no_item", "item_id", "score", "no_id", "doc_id"])

    schema = "no_item boolean, item_id long, score long, no_id boolean, doc_id long"
    return index.groupBy("shard").applyInPandas(run, schema)


def searched(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``top`` best documents with a score above 0."""
    heaps = None
    for wanted in _passes(item_terms(items)):
        found = _searched(docs, wanted, top)
        heaps = found if heaps is None else heaps.unionByName(found)
    if heaps is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = Window.partitionBy("no_item", "item_id").orderBy(F.col("score").desc(), "no_id", "doc_id")
    ranked = heaps.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select(
        F.when(~F.col("no_item"), F.col("item_id")).alias("item_id"),
        F.col("rank"),
        F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"),
        "score",
    )
