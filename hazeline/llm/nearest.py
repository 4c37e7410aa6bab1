"""Nearest neighbours by inner product with multiprobe p-stable hashing.

Vectors are scaled by the largest length and completed to length 1 by one more component,
queries are scaled to length 1, so that the largest inner product is the smallest distance.
A table cuts projections on Gaussian (2-stable) directions into cells. Let p be a query's
projection: that of a vector with inner product s is then normal around s p with deviation
sqrt(1 - s^2), whatever the data are, since the direction was drawn apart from them. So
the chance of finding a neighbour in a perturbed cell is known, and

1. every query visits its own cell in each table, where its 20 best give a lower bound for s;
2. with that bound, cells are put in the order of their estimated success and visited until
   the chances add up to the wanted share of neighbours; only products above the bound return;
3. a query that has fewer than 20 neighbours then is held against all rows, in blocks.

The candidates of all tables are merged, scored exactly and ranked. Cells are compared in
blocks of bounded size on both sides, however full they are. Equal vectors are one candidate
with its 21 smallest ids, which is all that a result can show, so copies cost nothing.

The widths of the cells are fitted on SAMPLE vectors; the index holds every vector. With few
vectors there is one cell, and the search is exact. ``recall`` measures against brute force.

Edge cases: rows with a null id, and vectors that are null, empty, zero or have null or
non-finite components, take no part; vectors of different length have no inner product;
equal rows count once; an id with several vectors has its best score with any of them and is
never its own neighbour; equal scores go to the smaller id; a query without candidates has
no rows; very long vectors are read whole; other columns are not read.
"""

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hazeline.session import write_and_reread

TOP = 20
#: Every row whose id this divides is a query.
QUERIES = 20
TABLES = 2
#: Share of the neighbours that each table is to find; of all, a share of 1 - 0.2 * 0.2.
COVERED = 0.8
#: Chance that may be left out of an enumeration of cells.
SLACK = 0.002
#: Vectors of a cell, about, and of one side of a block.
CELL, BLOCK = 2048, 4096
#: Width of a cell in deviations of the data's projections, and most directions of a table.
WIDTH, MOST_HASHES = 2.0, 12
#: Vectors that the widths are fitted on.
SAMPLE = 4096
#: Parts of a cell that its counts are joined in.
SPREAD = 16
SLICE, PRODUCTS = 512, 20_000
_erf = np.frompyfunc(math.erf, 1, 1)


def vectors(df: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, v`` of the rows that take part."""
    v = F.col(f"`{column}`")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fit = F.col(f"`{id_column}`").isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)
    return df.where(F.coalesce(fit, F.lit(False))).select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), v.alias("v"))


def longest(rows: DataFrame) -> tuple[int, float]:
    """How many vectors there are, and the length of the longest.

    Lengths are summed in units of the largest component, so that no square overflows.
    """
    most = F.array_max(F.transform("v", lambda x: F.abs(x).cast("double")))
    found = rows.agg(F.count("*").alias("n"), F.max(most).alias("most")).first()
    if not found["n"]:
        return 0, 1.0
    unit = lambda x: x / F.lit(found["most"])
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + unit(x) * unit(x))
    return found["n"], found["most"] * math.sqrt(rows.agg(F.max(square)).first()[0])


def _classes(rows: DataFrame) -> DataFrame:
    """``v, ids``: each distinct vector with its TOP + 1 smallest ids, in order."""
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    kept = rows.distinct().withColumn("place", first).where(F.col("place") <= TOP + 1)
    return kept.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


@dataclass(frozen=True)
class Family:
    """The hash functions of all tables: ``hashes`` directions each, for vectors of any length.

    ``fitted`` has middle and deviation of the projections by length, as far as sampled.
    """

    hashes: int
    longest: float
    fitted: dict

    def directions(self, dim: int) -> np.ndarray:
        return np.random.default_rng([7, dim]).standard_normal((TABLES * self.hashes, dim + 1))

    def widths(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower edge of cell 0, and width, of each hash function."""
        middle, deviation = self.fitted.get(dim, (0.0, 1.0))
        width = WIDTH * np.broadcast_to(deviation, TABLES * self.hashes)
        return middle - width * np.random.default_rng([8, dim]).random(len(width)), width

    def projected(self, matrix: np.ndarray, query: bool) -> np.ndarray:
        """Projections of vectors as they stand; queries are scaled, all others also completed."""
        directions = self.directions(matrix.shape[1])
        if query:
            scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
            return scaled @ directions[:, :-1].T / np.linalg.norm(scaled, axis=1, keepdims=True)
        unit = matrix / self.longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(axis=1)))
        return unit @ directions[:, :-1].T + rest[:, None] * directions[:, -1]

    def cells(self, projections: np.ndarray, dim: int) -> np.ndarray:
        low, width = self.widths(dim)
        return np.floor((projections - low) / width).astype(np.int64)


def cell_keys(cells: np.ndarray, dim: int) -> np.ndarray:
    """One number for the cell numbers of each row; equal ones only by chance for others."""
    keys = np.full(len(cells), dim, dtype=np.uint64)
    for column in np.ascontiguousarray(cells.T).view(np.uint64):
        keys = (keys ^ column) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def _fitted(sample: list[np.ndarray], family: Family) -> dict:
    by_length: dict = {}
    for v in sample:
        by_length.setdefault(len(v), []).append(v)
    out = {}
    for dim, own in by_length.items():
        values = family.projected(np.array(own), query=False)
        deviation = values.std(axis=0)
        out[dim] = values.mean(axis=0), np.where(deviation > 1e-6, deviation, 1.0)
    return out


def probes(p: np.ndarray, s: float, low: np.ndarray, width: np.ndarray, covered: float = COVERED) -> np.ndarray:
    """Cells of one table in the order of the chance that a neighbour of inner product ``s`` is there.

    ``p`` has the query's projections. The cells end where their chances reach ``covered``.
    """
    s = min(max(s, -1.0), 1.0)
    spread = max(math.sqrt(1.0 - s * s), 1e-6)
    cells, chances = np.zeros((1, 0), dtype=np.int64), np.ones(1)
    slack = SLACK / max(len(p), 1)
    for at, edge, w in zip(s * p, low, width):
        first, last = (math.floor((at + side * 4 * spread - edge) / w) for side in (-1, 1))
        numbers = np.arange(first, last + 1)
        edges = (edge + w * np.arange(first, last + 2) - at) / (spread * math.sqrt(2))
        own = np.diff(0.5 * (1 + _erf(edges).astype(float)))
        cells = np.hstack([np.repeat(cells, len(numbers), axis=0), np.tile(numbers, len(cells))[:, None]])
        chances = np.outer(chances, own).ravel()
        order = np.argsort(-chances, kind="stable")
        left_out = np.cumsum(chances[order][::-1])[::-1] <= slack
        order = order[~left_out]
        cells, chances = cells[order], chances[order]
    return cells[: int(np.searchsorted(np.cumsum(chances), covered)) + 1]


def _matrices(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the vectors of each length."""
    values = [np.asarray(v, dtype=float) for v in column]
    lengths = np.array([len(v) for v in values])
    return [(at, np.array([values[i] for i in at])) for at in (np.flatnonzero(lengths == d) for d in np.unique(lengths))]


def _placed(classes: DataFrame, family: Family) -> DataFrame:
    """``slot, cell, ids, v``: every vector's cell in each table."""

    def run(batches):
        for batch in batches:
            for at, matrix in _matrices(batch["v"]):
                cells = family.cells(family.projected(matrix, query=False), matrix.shape[1])
                for t in range(TABLES if family.hashes else 1):
                    own = cells[:, t * family.hashes : (t + 1) * family.hashes]
                    yield batch.iloc[at].assign(slot=t, cell=cell_keys(own, matrix.shape[1]))[["slot", "cell", "ids", "v"]]

    kind = dict(classes.dtypes)["v"]
    return classes.select("ids", "v").mapInPandas(run, f"slot int, cell long, ids array<long>, v {kind}")


def _visits(queries: DataFrame, family: Family, first: bool) -> DataFrame:
    """``slot, cell, query_id, least, v``: the cells that queries visit, their own or all others."""

    def run(batches):
        for batch in batches:
            for at, matrix in _matrices(batch["v"]):
                dim = matrix.shape[1]
                p = family.projected(matrix, query=True)
                home = family.cells(p, dim)
                low, width = family.widths(dim)
                lengths = np.linalg.norm(matrix / np.abs(matrix).max(axis=1, keepdims=True), axis=1) * np.abs(matrix).max(axis=1)
                least = batch["least"].to_numpy(dtype=float)[at]
                s = np.where(np.isnan(least), 0.0, least / (lengths * family.longest))
                own = batch.iloc[at]
                for t in range(TABLES if family.hashes else 1):
                    of = slice(t * family.hashes, (t + 1) * family.hashes)
                    if first:
                        yield own.assign(slot=t, cell=cell_keys(home[:, of], dim))[columns]
                        continue
                    for start in range(0, len(at), SLICE):
                        part = range(start, min(start + SLICE, len(at)))
                        visited = [probes(p[i, of], s[i], low[of], width[of]) for i in part]
                        visited = [c[(c != home[i, of]).any(axis=1)] for c, i in zip(visited, part)]
                        rows = own.iloc[np.repeat(np.array(part), [len(c) for c in visited])]
                        if len(rows):
                            yield rows.assign(slot=t, cell=cell_keys(np.concatenate(visited), dim))[columns]

    columns = ["slot", "cell", "query_id", "least", "v"]
    kind = dict(queries.dtypes)["v"]
    return queries.select("query_id", "least", "v").mapInPandas(
        run, f"slot int, cell long, query_id long, least double, v {kind}"
    )


def best_of_block(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
    """``query_id, vec_id, score`` of each query's TOP best candidates that are not below ``least``."""
    found = []
    by_length = {matrix.shape[1]: (at, matrix) for at, matrix in _matrices(candidates["v"])}
    all_ids = [np.asarray(i, dtype=np.int64) for i in candidates["ids"]]
    for at, matrix in _matrices(queries["v"]):
        if matrix.shape[1] not in by_length:
            continue
        places, others = by_length[matrix.shape[1]]
        ids = [all_ids[i] for i in places]
        copies = np.array([len(i) for i in ids])
        starts, flat = np.cumsum(copies) - copies, np.concatenate(ids)
        most = np.linalg.norm(others, axis=1).max()
        for start in range(0, len(at), SLICE):
            rows = at[start : start + SLICE]
            own, query_ids = matrix[start : start + SLICE], queries["query_id"].to_numpy()[rows]
            near = own @ others.T
            limit = queries["least"].to_numpy(dtype=float)[rows]
            limit = np.where(np.isnan(limit), -np.inf, limit)
            if len(others) > TOP + 1:
                limit = np.maximum(limit, np.partition(near, len(others) - TOP - 1, axis=1)[:, len(others) - TOP - 1])
            # the matrix product may differ in its last places from the score
            limit = limit - 1e-12 * matrix.shape[1] * np.linalg.norm(own, axis=1) * most
            r, c = np.nonzero(near >= limit[:, None])
            if not len(r):
                continue
            score = np.concatenate(
                [(own[r[i : i + PRODUCTS]] * others[c[i : i + PRODUCTS]]).sum(axis=1) for i in range(0, len(r), PRODUCTS)]
            )
            times = copies[c]
            inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            r, score, vec_id = np.repeat(r, times), np.repeat(score, times), flat[np.repeat(starts[c], times) + inner]
            other = vec_id != query_ids[r]
            r, score, vec_id = r[other], score[other], vec_id[other]
            order = np.lexsort((vec_id, -score, r))
            r, score, vec_id = r[order], score[order], vec_id[order]
            rank = np.arange(len(r)) - np.searchsorted(r, r)
            good = rank < TOP
            found.append(pd.DataFrame({"query_id": query_ids[r[good]], "vec_id": vec_id[good], "score": score[good]}))
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def _compared(visits: DataFrame, placed: DataFrame) -> DataFrame:
    """``query_id, vec_id, score``: the best of every visited cell, in blocks of bounded size."""
    cell = ["slot", "cell"]
    parts = lambda: F.ceil(F.count("*") / BLOCK).cast("int")
    sizes = placed.groupBy(*cell).agg(parts().alias("parts_c"))
    asked = visits.groupBy(*cell).agg(parts().alias("parts_q"))
    # one cell may have a third of all rows, so the counts go to each of SPREAD parts of a cell
    parts_of = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    both = sizes.join(asked, cell).withColumn("part", parts_of)
    drawn = lambda column, count: F.pmod(F.xxhash64(column), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    part = lambda column: F.pmod(F.xxhash64(column, F.lit("part")), F.lit(SPREAD)).cast("int")
    left = visits.withColumn("part", part("query_id")).join(both, [*cell, "part"])
    left = left.withColumn("part_q", drawn("query_id", "parts_q")).withColumn("part_c", every("parts_c"))
    right = placed.withColumn("part", part("ids")).join(both, [*cell, "part"])
    right = right.withColumn("part_c", drawn("ids", "parts_c")).withColumn("part_q", every("parts_q"))
    block = [*cell, "part_q", "part_c"]
    return (
        left.select(*block, "query_id", "least", "v")
        .groupBy(*block)
        .cogroup(right.select(*block, "ids", "v").groupBy(*block))
        .applyInPandas(lambda q, c: best_of_block(q, c), "query_id long, vec_id long, score double")
    )


def _merged(found: DataFrame) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the TOP best of all candidates found."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= TOP).select("query_id", "rank", "vec_id", "score")


def nearest(df: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the TOP nearest of every query, nearest first."""
    rows = vectors(df, id_column, column)
    classes = write_and_reread(_classes(rows), "classes")
    total, most = longest(classes)
    cells = total / CELL
    hashes = min(MOST_HASHES, math.ceil(math.log2(cells) / 1.2)) if cells > 1 else 0
    family = Family(hashes, most, {})
    sample = classes.select("v").orderBy(F.xxhash64("v")).limit(SAMPLE if hashes else 0).collect()
    family = Family(hashes, family.longest, _fitted([np.array(r["v"], dtype=float) for r in sample], family) if hashes else {})

    placed = write_and_reread(_placed(classes, family), "cells")
    queries = rows.where(F.col("vec_id") % QUERIES == 0).distinct()
    queries = write_and_reread(queries.select(F.col("vec_id").alias("query_id"), F.lit(None).cast("double").alias("least"), "v"), "queries")
    found = write_and_reread(_compared(_visits(queries, family, first=True), placed), "found")
    if not hashes:
        return _merged(found)

    worst = _merged(found).groupBy("query_id").agg(F.max("rank").alias("known"), F.min("score").alias("worst"))
    bounded = worst.where(F.col("known") == TOP).select("query_id", F.col("worst").alias("least"))
    asking = queries.drop("least").join(bounded, "query_id", "left")
    more = write_and_reread(_compared(_visits(asking, family, first=False), placed), "found")
    found = found.unionByName(more)

    enough = _merged(found).groupBy("query_id").count().where(F.col("count") == TOP)
    short = write_and_reread(queries.join(enough, "query_id", "left_anti"), "short")
    if not short.isEmpty():
        blocks = -(-total // BLOCK)
        dealt = placed.where("slot = 0").withColumns({"slot": F.lit(-1), "cell": F.pmod(F.xxhash64("ids", "v"), F.lit(blocks))})
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
        visits = short.select(F.lit(-1).alias("slot"), every.alias("cell"), "query_id", "least", "v")
        found = found.unionByName(_compared(visits, dealt))
    return _merged(found)


def recall(found: DataFrame, df: DataFrame, sample: int = 200, id_column: str = "vec_id", column: str = "embedding") -> float:
    """Share of the true neighbours of ``sample`` queries, drawn by a hash, that were found.

    The queries of the sample are held against all rows; each task keeps their best only.
    """
    rows = vectors(df, id_column, column)
    asked = rows.where(F.col("vec_id") % QUERIES == 0).distinct().orderBy(F.xxhash64("vec_id"), "v").limit(sample)
    drawn = asked.select(F.col("vec_id").alias("query_id"), F.lit(None).cast("double").alias("least"), "v").toPandas()

    def run(batches):
        for batch in batches:
            yield best_of_block(drawn, batch)

    singles = rows.select(F.array("vec_id").alias("ids"), "v")
    true = _merged(singles.mapInPandas(run, "query_id long, vec_id long, score double"))
    worst = true.groupBy("query_id").agg(F.min("score").alias("worst"), F.count("*").alias("n"))
    hits = found.join(worst, "query_id").where(F.col("score") >= F.col("worst") - 1e-9).groupBy("query_id", "n").count()
    row = worst.join(hits.select("query_id", F.least("count", "n").alias("hit")), "query_id", "left").agg(
        F.sum(F.coalesce("hit", F.lit(0))) / F.sum("n")
    )
    return float(row.first()[0] or 0.0)
