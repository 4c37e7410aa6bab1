"""Near-duplicate groups of documents by bottom-k sketches and exact Jaccard similarity.

One hash function turns a document's word shingles into a set of numbers; the K smallest are
its sketch. Documents with equal sets are one node from the start. Then:

1. *Lists.* Each retained value has a list of the nodes that retain it. Two sets as similar
   as asked for share at least ``least_shared`` sketch values, so with the values in a common
   order, rarest first, they share one among the first ``len(sketch) - least_shared + 1``.
   Only those are listed: values of passages that very many documents share come last and
   are listed only for documents that consist of little else.
2. *Centres.* In each list the node with the most common values, the likely original, is
   paired with every other node: as many pairs as entries. The union of two sketches has a
   sketch of its own, whose shared part estimates the similarity; a pair that falls short of
   any plausible estimate is dropped. Of the others the full sets are built from the texts
   and compared exactly, and the links give components.
3. *Strays.* Any two nodes of a list have its centre in common, so what is left are pairs of
   nodes around one centre, at least one of them outside the centre's component. All nodes
   around a centre that has strays go through steps 1 and 2 once more with larger sketches,
   and what then has strays with the largest. A larger sketch asks for a share of common values
   that is nearer to the one that similar sets have, so that fewer of the values of a
   shared passage are listed: documents of which half is the same page template meet in no list
   of the last level. Pairs that are in one component already are not compared again.
4. *Blocks.* The last strays are held against all nodes around their centre in blocks of
   bounded size, sets of too different sizes apart: a block compares the sketches of its
   two sides at once, as a product of indicator matrices, and only the texts of what they do
   not rule out are fetched. A stray needs one link to each other component, so these pairs are compared in
   waves, each a larger share of what is left; pairs that the links of a wave have joined are not compared, and later
   waves hold only strays of which pairs are left.
   Nodes within the centre's component are never paired with each other.

LEVELS has the size of each level's sketches and how many values two sets of exactly the
threshold's similarity share but for a chance below 1e-6; sets up to 0.8 of a sketch's size are compared as a
whole, without chance.

Edge cases: null texts and texts without words have no shingles, link with nothing and are
their own component; shorter texts than a shingle are one shingle; repeated rows are copies;
a null id takes the smallest id of its component, null if there is none; very long texts are
read whole; other columns are not read, or kept as they are by ``deduplicated``.
"""

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hazeline.llm.common import attached, in_parts, keyed, row_keys
from hazeline.llm.components import connected, merged
from hazeline.session import write_and_reread

#: Values of a sketch, and how many of them two sets of the asked similarity share at least, by level.
LEVELS = ((32, 13), (128, 79), (512, 364))
K = LEVELS[0][0]
#: Asked similarity, in hundredths.
SIMILAR = 80
#: Words of a shingle where nothing else is said.
WIDTH = 5
#: Nodes of one side of a block, on average, and columns of an indicator matrix at most.
BLOCK, COLUMNS = 512, 8192
#: Pairs of a stray and a component that the first wave compares, and how many times more each next one.
WAVE, WIDER = 64, 16
#: Centres whose sketches are sent to every executor, at most: 4 MB of the largest ones.
HOT_CENTRES = 1000
#: Bytes of texts whose words are hashed together, and of the longest words hashed so.
TOGETHER, LONG = 1 << 18, 64
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: Iterable[str], width: int) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct hashes of its shingles; words end at ASCII white space."""
    held, size = [], 0
    for text in texts:
        held.append(text.encode().lower())  # of bytes: only A-Z and ASCII white space count
        size += len(held[-1])
        if size >= TOGETHER:
            yield from _sets_of(held, width)
            held, size = [], 0
    yield from _sets_of(held, width)


def _sets_of(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """``shingle_sets`` of some texts whose words are found and hashed together."""
    joined = b" ".join([b"", *texts, b""])
    raw = np.frombuffer(joined + bytes(16 - len(joined) % 8), dtype=np.uint8)
    own = raw[: len(joined)]
    blank = (own == 0x20) | (own - np.uint8(0x09) < 5)
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1  # the first and the last byte are blank
    starts, ends = edges[::2], edges[1::2]
    hashes = _word_hashes(joined, raw, starts, ends - starts)
    whole = _combined(hashes, width)
    places = np.cumsum([1, *[len(t) + 1 for t in texts]])
    bounds = np.searchsorted(starts, places)
    for first, last in zip(bounds[:-1], bounds[1:]):
        some = whole[first : last - width + 1] if last - first >= width else _combined(hashes[first:last], last - first)
        some = np.sort(some.view(np.int64))
        yield some[np.concatenate([np.ones(min(len(some), 1), dtype=bool), some[1:] != some[:-1]])]


def _word_hashes(joined: bytes, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, from eight bytes at a time; ``raw`` has eight more bytes than the words at least."""
    lanes = raw.view("<u8")
    out = _mixed(lengths.astype(np.uint64))
    for i in np.flatnonzero(lengths > LONG):
        out[i] = xxhash.xxh3_64_intdigest(joined[starts[i] : starts[i] + lengths[i]])
    live = np.flatnonzero(lengths <= LONG)
    at, left = starts[live], lengths[live]
    while len(live):
        lane, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        part = (lanes[lane] >> shift) | (lanes[lane + 1] << np.uint64(1) << (np.uint64(63) - shift))
        unused = ((8 - np.minimum(left, 8)) << 3).astype(np.uint64)
        out[live] = _mixed(out[live] * FACTOR + (part << unused))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return out


def _combined(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` words in a row."""
    count = max(len(hashes) - width + 1, 0) if width else 0
    total = np.full(count, width, dtype=np.uint64)
    for i in range(width):
        total = _mixed(total * FACTOR + hashes[i : i + count])
    return total


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def sketched(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, id_key, version, n_shingles, set_key, sketch`` of every document."""

    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(batch["text"], width))
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            out = batch[["no_id", "id_key", "version"]]
            yield out.assign(n_shingles=[len(s) for s in sets], set_key=digests, sketch=[s[:K] for s in sets])

    rows = keyed(docs).select(F.col("doc_id").isNull().alias("no_id"), "id_key", "version", "text")
    schema = "no_id boolean, id_key long, version long, n_shingles long, set_key binary, sketch array<long>"
    done = rows.mapInPandas(run, schema)
    return done.select(F.when(~F.col("no_id"), F.col("id_key")).alias("doc_id"), *done.columns[1:])


def _nodes(sketches: DataFrame) -> DataFrame:
    """One node for each distinct set, with the place of one of its texts and its smallest id."""
    one = F.min(F.struct("id_key", "version", F.col("n_shingles").alias("n"), "sketch")).alias("one")
    copies = F.count("*").alias("copies")
    sets = sketches.where(F.col("n_shingles") > 0).groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), copies, one)
    return sets.select(F.monotonically_increasing_id().alias("node"), "set_key", "doc_id", "copies", "one.*")


def least_shared(n: Column, level: int = 0) -> Column:
    """How many sketch values a set of this size shares with any that is similar enough."""
    size, least = LEVELS[level]
    whole = F.ceil(n * SIMILAR / 100)  # so small that any partner's sketch is its whole set
    return F.when(n <= size * SIMILAR // 100, whole).otherwise(F.lit(least)).cast("int")


def _lists(nodes: DataFrame, level: int = 0) -> DataFrame:
    """``value, node, n, common``: the lists' entries; ``common`` sums how often the node's values occur."""
    entries = nodes.select("node", "n", F.size("sketch").alias("kept"), F.explode("sketch").alias("value"))
    often = entries.groupBy("value").agg(F.count("*").alias("often")).where(F.col("often") > 1)
    often = often.withColumn("size", F.col("often"))
    shared = attached(entries, often, ["value"], "size", nodes.count() * LEVELS[level][0])
    own = Window.partitionBy("node")  # at most a sketch's rows
    ranked = shared.select(
        "*",
        F.row_number().over(own.orderBy("often", "value")).alias("rank"),
        F.count("*").over(own).alias("met"),
        F.sum("often").over(own).alias("common"),
    )
    # values that no other node has come first in the order and need no list
    first = F.col("kept") - least_shared(F.col("n"), level) + 1 - (F.col("kept") - F.col("met"))
    return ranked.where(F.col("rank") <= first).select("value", "node", "n", "common")


def _sizes_fit(n: str, m: str) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * SIMILAR


def _around(lists: DataFrame) -> DataFrame:
    """``centre, centre_n, node, n``: the nodes around each centre, the centre itself among them."""
    centre = F.max(F.struct("common", (-F.col("node")).alias("order"), "node", "n")).alias("c")
    centres = lists.groupBy("value").agg(centre, F.count("*").alias("size")).where(F.col("size") > 1)
    named = centres.select("value", F.col("c.node").alias("centre"), F.col("c.n").alias("centre_n"), "size")
    rows = attached(lists.select("value", "node", "n"), named, ["value"], "size", lists.count())
    return rows.select("centre", "centre_n", "node", "n").distinct()


def _placed(around: DataFrame, components: DataFrame) -> DataFrame:
    """The nodes around each centre with their components, and whether that is another than the centre's, as a table."""
    found = components.withColumnRenamed("component", "found")
    own = around.join(found, "node", "left").withColumn("component", F.coalesce("found", "node")).drop("found")
    sizes = around.groupBy("centre").agg(F.count("*").alias("size"))
    home = sizes.join(found.withColumnRenamed("node", "centre"), "centre", "left")
    home = home.select("centre", "size", F.coalesce("found", "centre").alias("home"))
    rows = attached(own, home, ["centre"], "size", around.count())
    return write_and_reread(rows.withColumn("stray", F.col("component") != F.col("home")).drop("home"), "placed")


def _near_strays(placed: DataFrame) -> DataFrame:
    """``node``: all nodes around centres that have strays."""
    sizes = placed.groupBy("centre").agg(F.count("*").alias("size"), F.count_if("stray").alias("strays"))
    near = attached(placed.select("centre", "node"), sizes.where("strays > 0"), ["centre"], "size", placed.count())
    return near.select("node").distinct()


def _strays(placed: DataFrame) -> DataFrame:
    """Strays and the nodes around their centres, dealt to pairs of blocks.

    A block is a part of the nodes of one centre and one class of sizes, drawn by a hash;
    the parts' numbers follow from counts. ``side`` a has the strays, side b all nodes.
    """
    # sets that are similar enough are in one class or in neighbouring ones
    own = placed.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / SIMILAR))).cast("int"))
    own = own.select("centre", "class", "node", "component", "stray")
    parts = lambda count: F.ceil(count / BLOCK).cast("int")
    counts = own.groupBy("centre", "class").agg(
        F.count("*").alias("size"), parts(F.count("*")).alias("own_b"), parts(F.count_if("stray")).alias("own_a")
    )
    others = counts.select("centre", F.struct(F.col("class").alias("class"), F.col("own_a").alias("a"), F.col("own_b").alias("b")).alias("near"))
    # a centre has some dozens of classes, each with at most three near ones
    near = counts.join(others, "centre").where(F.abs(F.col("class") - F.col("near.class")) <= 1)
    near = near.groupBy("centre", "class", "size", "own_a", "own_b").agg(F.collect_list("near").alias("near"))
    near = near.where(F.exists("near", lambda other: other["a"] > 0) | (F.col("own_a") > 0))
    dealt = attached(own, near, ["centre", "class"], "size", placed.count()).withColumn("near", F.explode("near"))
    part = lambda count: F.pmod(F.xxhash64("node"), count).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    side_a = dealt.where("stray").select(
        "centre", F.col("class").alias("class_a"), part("own_a").alias("part_a"), F.col("near.class").alias("class_b"),
        every("near.b").alias("part_b"), F.lit("a").alias("side"), "node", "component",
    )
    side_b = dealt.where("near.a > 0").select(
        "centre", F.col("near.class").alias("class_a"), every("near.a").alias("part_a"), F.col("class").alias("class_b"),
        part("own_b").alias("part_b"), F.lit("b").alias("side"), "node", "component",
    )
    return side_a.unionByName(side_b)


def common_sizes(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each set of one side shares with each of the other."""
    both = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)))
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, len(both), COLUMNS):
        some = both[at : at + COLUMNS]
        sides = []
        for sets in (left, right):
            matrix = np.zeros((len(sets), len(some)), dtype=np.float32)
            for row, values in enumerate(sets):
                place = np.minimum(np.searchsorted(some, values), len(some) - 1)
                matrix[row, place[some[place] == values]] = 1
            sides.append(matrix)
        out += sides[0] @ sides[1].T
    return out


def _candidates(left: dict, right: dict, most: int, size: int, least: int) -> dict:
    """Pairs of a block that the sketch of their union does not rule out.

    The sides are columns. Of each stray and other component the ``most`` with the highest estimates are given;
    ``cut`` says that there are more. ``size`` and ``least`` are those of the sketches' level.
    """
    sketches = [list(side["sketch"]) for side in (left, right)]
    common = common_sizes(*sketches)
    kept = [np.array([len(s) for s in side]) for side in sketches]
    either = kept[0][:, None] + kept[1][None, :] - common
    whole = (left["n"] <= size)[:, None] & (right["n"] <= size)[None, :]
    possible = np.where(whole, common * 100 >= either * SIMILAR, common >= least)
    possible &= left["component"][:, None] != right["component"][None, :]
    seen = np.zeros(possible.shape, dtype=np.int64)
    for row in np.flatnonzero(possible.any(axis=1)):
        places = np.flatnonzero(possible[row])
        seen[row, places] = _seen(sketches[0][row], [sketches[1][p] for p in places], size)
    rows, places = np.nonzero(possible & (whole | (seen >= least)))
    a, b, component, seen = left["node"][rows], right["node"][places], right["component"][places], seen[rows, places]
    order = np.lexsort((b, -seen, component, a))
    a, b, component = a[order], b[order], component[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(a), 1), dtype=bool), (a[1:] != a[:-1]) | (component[1:] != component[:-1])]))
    counts = np.diff([*first, len(a)])
    given = np.arange(len(a)) - np.repeat(first, counts) < most
    return {"a": a[given], "b": b[given], "cut": np.repeat(counts > most, counts)[given]}


def _seen(own: np.ndarray, others: list[np.ndarray], size: int) -> np.ndarray:
    """How many values of the sketch of the union with each other sketch are in both."""
    values = np.concatenate(others)
    lengths = np.array([len(s) for s in others])
    other, rank = np.repeat(np.arange(len(others)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = np.searchsorted(own, values)
    both = np.flatnonzero(own[np.minimum(place, len(own) - 1)] == values)
    other, rank, place = other[both], rank[both], place[both]
    counts = np.bincount(other, minlength=len(others))
    before = np.arange(len(both)) - np.repeat(np.cumsum(counts) - counts, counts)
    # a shared value's place in the union: after those of both sides, of which the shared ones count once
    return np.bincount(other[rank + place - before < size], minlength=len(others))


def _runs(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[dict]:
    """The columns of each run of rows with the same keys, from batches in the order of the keys."""
    rest = None
    for batch in batches:
        rows = {c: batch[c].to_numpy() for c in batch}
        if rest is not None:
            rows = {c: np.concatenate([rest[c], own]) for c, own in rows.items()}
        changes = np.any([rows[k][1:] != rows[k][:-1] for k in keys], axis=0)
        starts = [0, *(np.flatnonzero(changes) + 1)]
        for start, end in zip(starts, starts[1:]):
            yield {c: own[start:end] for c, own in rows.items()}
        rest = {c: own[starts[-1] :] for c, own in rows.items()}
    if rest is not None:
        yield rest


def _in_blocks(strays: DataFrame, nodes: DataFrame, most: int, level: int) -> DataFrame:
    """``a, b, cut``: the candidate pairs of all blocks.

    Most blocks are small, so they follow each other in sorted partitions instead of being a group each.
    """

    size, least = LEVELS[level]
    block = ["centre", "class_a", "part_a", "class_b", "part_b"]

    def run(batches):
        for rows in _runs(batches, block):
            left, right = ({c: own[rows["side"] == side] for c, own in rows.items()} for side in "ab")
            if len(left["node"]) and len(right["node"]):
                found = _candidates(left, right, most, size, least)
                if len(found["a"]):
                    yield pd.DataFrame(found)

    dealt = strays.join(nodes.select("node", "n", "sketch"), "node")
    return dealt.repartition(*block).sortWithinPartitions(*block).mapInPandas(run, "a long, b long, cut boolean")


def _apart(pairs: DataFrame, components: DataFrame) -> DataFrame:
    """The pairs of nodes that are in different components."""
    for end in ("a", "b"):
        named = components.withColumnsRenamed({"node": end, "component": f"_{end}"})
        pairs = pairs.join(named, end, "left").withColumn(f"_{end}", F.coalesce(f"_{end}", end))
    return pairs.where("_a <> _b").drop("_a", "_b")


def _plausible(pairs: DataFrame, nodes: DataFrame, level: int = 0, places=()) -> DataFrame:
    """The pairs that the sketch of their union does not rule out, with ``places`` of their nodes."""
    size, least = LEVELS[level]
    facts = ["n", "sketch", *places]
    of = lambda end: nodes.select(F.col("node").alias(end), *[F.col(f).alias(f"{f}_{end}") for f in facts])
    pairs = write_and_reread(pairs, "pairs")
    centres = pairs.groupBy("b").agg(F.count("*").alias("size")).join(of("b"), "b")
    pairs = attached(pairs, centres, ["b"], "size", pairs.count(), most_hot=HOT_CENTRES).join(of("a"), "a")
    both, either = F.array_intersect("sketch_a", "sketch_b"), F.array_union("sketch_a", "sketch_b")
    seen = F.size(F.array_intersect(both, F.slice(F.array_sort(either), 1, size)))
    whole = (F.col("n_a") <= size) & (F.col("n_b") <= size)
    fits = F.when(whole, F.size(both) * 100 >= F.size(either) * SIMILAR).otherwise(seen >= least)
    return pairs.where(fits).select("a", "b", *[f"{f}_{e}" for e in ("a", "b") for f in places])


def _verified(pairs: DataFrame, texts: DataFrame, keys, width: int) -> DataFrame:
    """``a, b`` of the pairs whose full shingle sets are similar enough.

    ``texts`` has a text for each value of the ``keys``, which the pairs have as ``<key>_a`` and ``<key>_b``.
    """
    keys = list(keys)
    pairs = write_and_reread(pairs, "plausible")
    named = pairs.withColumnsRenamed({f"{k}_a": k for k in keys})
    with_a = named.join(texts, keys).withColumnRenamed("text", "text_a").drop(*keys)
    # many pairs may have one centre, whose text then goes to several tasks
    ends = {f"{k}_b": k for k in keys}
    counted = pairs.select(*ends).withColumnsRenamed(ends)
    pairs = in_parts(with_a.withColumnsRenamed(ends), texts, keys, "a", counted).withColumnRenamed("text", "text_b").drop(*keys)

    def run(batches):
        for batch in batches:
            good, kept = [], None
            new = batch["b"] != batch["b"].shift()
            ends = shingle_sets(batch["text_b"][new], width)
            for other, own in zip(new, shingle_sets(batch["text_a"], width)):
                kept = next(ends) if other else kept
                common = len(np.intersect1d(own, kept, assume_unique=True))
                good.append(100 * common >= SIMILAR * (len(own) + len(kept) - common))
            yield batch.loc[good, ["a", "b"]]

    return pairs.select("a", "b", "text_a", "text_b").mapInPandas(run, "a long, b long")


def _sketches_of(texts: DataFrame, width: int, size: int) -> DataFrame:
    """``node, n, sketch`` from ``node, text``."""

    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(batch["text"], width))
            yield pd.DataFrame({"node": batch["node"], "n": [len(s) for s in sets], "sketch": [s[:size] for s in sets]})

    return texts.mapInPandas(run, "node long, n long, sketch array<long>")


def _stars(around: DataFrame) -> DataFrame:
    """Each node paired with the centres it is around."""
    stars = around.where((F.col("node") != F.col("centre")) & _sizes_fit("n", "centre_n"))
    return stars.select(F.col("node").alias("a"), F.col("centre").alias("b"))


def _on_places(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns({"node_a": F.col("a"), "node_b": F.col("b")})


def grouped(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document, and ``id_key, version, component``."""
    sketches = write_and_reread(sketched(docs, width), "sketches")
    nodes = write_and_reread(_nodes(sketches), "nodes")
    lists = write_and_reread(_lists(nodes), "lists")
    around = write_and_reread(_around(lists), "around")
    place = ["id_key", "version"]
    all_texts = keyed(docs).select(*place, "text")
    pairs = _plausible(_stars(around), nodes, places=place)
    components = connected(write_and_reread(_verified(pairs, all_texts, place, width), "links"))

    near = write_and_reread(_near_strays(_placed(around, components)), "near")
    if not near.isEmpty():
        wanted = nodes.join(near, "node").select("node", *place)
        texts = write_and_reread(wanted.join(all_texts, place).select("node", "text").dropDuplicates(["node"]), "texts")
        components = _linked_again(texts, near, components, width)
    return _labelled(sketches, nodes, components)


def _linked_again(texts: DataFrame, near: DataFrame, components: DataFrame, width: int) -> DataFrame:
    """Components after the further levels and the blocks, for the nodes near strays."""
    for level in range(1, len(LEVELS)):
        own = texts.join(near, "node", "left_semi")
        nodes = write_and_reread(_sketches_of(own, width, LEVELS[level][0]), "nodes")
        around = write_and_reread(_around(write_and_reread(_lists(nodes, level), "lists")), "around")
        placed = _placed(around, components)
        pairs = _plausible(_stars(placed.where("stray")), nodes, level)
        more = write_and_reread(_verified(_on_places(pairs), texts, ["node"], width), "links")
        if not more.isEmpty():
            components = merged(components, more)
            placed = _placed(around, components)
        near = write_and_reread(_near_strays(placed), "near")
        if near.isEmpty():
            return components

    most, level, compared = WAVE, len(LEVELS) - 1, None
    while True:
        found = write_and_reread(_in_blocks(_strays(placed), nodes, most, level), "candidates")
        pairs = found.select("a", "b").distinct()
        fresh = pairs if compared is None else pairs.join(compared, ["a", "b"], "left_anti")
        more = write_and_reread(_verified(_on_places(fresh), texts, ["node"], width), "strays")
        if not more.isEmpty():
            components = merged(components, more)
        left = write_and_reread(_apart(found.where("cut").select("a", "b").distinct(), components).select("a").distinct(), "left")
        if left.isEmpty():
            return components
        # of all other nodes every pair that the blocks do not rule out is compared
        left = left.select(F.col("a").alias("node"), F.lit(True).alias("left"))
        placed = _placed(around, components).join(left, "node", "left").withColumn("stray", F.coalesce("left", F.lit(False)))
        placed, compared = write_and_reread(placed.drop("left"), "placed"), pairs if compared is None else compared.union(fresh)
        most *= WIDER


def _labelled(sketches: DataFrame, nodes: DataFrame, components: DataFrame) -> DataFrame:
    named = nodes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = named.select("set_key", "doc_id", "copies", "component")
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("size"))
    by_set = write_and_reread(attached(named.drop("doc_id"), smallest, ["component"], "size", nodes.count()), "sets")
    rows = attached(sketches.drop("sketch"), by_set, ["set_key"], "copies", sketches.count(), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.withColumn("component_id", component).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "id_key",
        "version",
        "component",
    )


def deduplicated(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One document of each group, the one of the smallest id, with all its columns.

    Documents without shingles all stay.
    """
    rows = grouped(docs, width)
    first = F.min(F.struct(~F.col("kept"), "id_key", "version")).alias("first")
    chosen = rows.where(F.col("component").isNotNull()).groupBy("component").agg(first).select("first.id_key", "first.version")
    empty = rows.where(F.col("component").isNull()).select("id_key", "version")
    chosen = write_and_reread(chosen.union(empty.distinct()), "chosen")
    names = {"id_key": "__chosen_id_key", "version": "__chosen_version"}  # apart from any column of the documents
    kept = docs.withColumns({names[c]: key for c, key in row_keys().items()}).join(chosen.withColumnsRenamed(names), list(names.values()), "left_semi")
    repeated = rows.where(F.col("component").isNotNull()).groupBy("id_key", "version").count().where("count > 1")
    if not repeated.join(chosen, ["id_key", "version"], "left_semi").isEmpty():
        kept = kept.dropDuplicates(list(names.values()))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
