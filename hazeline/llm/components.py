"""Connected components of a link table, as joins and minima."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import attached
from hazeline.session import write_and_reread


def _rank(node: str):
    """The order in which nodes give way to each other: random, but the same in every round."""
    return F.struct(F.xxhash64(node).alias("h"), F.col(node).alias("node"))


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the smallest node reached) of every node that has a link.

    Each round every node gives way to the one of the lowest rank among itself and its
    neighbours, and the links are carried over to those and freed of loops and repetitions.
    Ranks are hashes, so that of a chain, in whatever order its nodes are numbered, less
    than two thirds stay a round, and a hub's neighbours are gone in two: rounds are few
    however long the chains. A hub needs only a minimum, never its list of neighbours.
    The rows of hubs and of large components are joined where they are (``attached``).
    Rounds are kept as tables, so a lost executor costs one round at most; they end when no
    link is left.
    """
    ends = links.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = ends.union(ends.select("v", "u")).where(F.col("u") != F.col("v")).distinct()
    edges = write_and_reread(both, "edges")
    labels = None
    while not edges.isEmpty():
        lowest = F.least(F.first(_rank("u")), F.min(_rank("v")))["node"]
        moved = write_and_reread(edges.groupBy("u").agg(lowest.alias("to"), F.count("*").alias("size")), "moved")
        total = edges.count()
        if labels is None:
            labels = moved.select(F.col("u").alias("node"), F.col("to").alias("component"))
        else:
            sizes = labels.groupBy("component").agg(F.count("*").alias("size"))
            steps = sizes.join(moved.select(F.col("u").alias("component"), "to"), "component")
            stepped = attached(labels, steps, ["component"], "size", labels.count(), "left")
            labels = write_and_reread(
                stepped.select("node", F.coalesce("to", "component").alias("component")), "labels"
            )
        rows = edges.where(F.col("u") < F.col("v"))
        for end in ("u", "v"):
            rows = attached(rows, moved.withColumnsRenamed({"u": end, "to": f"to_{end}"}), [end], "size", total)
        carried = (
            rows.where(F.col("to_u") != F.col("to_v"))
            .select(F.least("to_u", "to_v").alias("u"), F.greatest("to_u", "to_v").alias("v"))
            .distinct()
        )
        edges = write_and_reread(carried.union(carried.select("v", "u")), "edges")
    if labels is None:
        return ends.select(F.col("u").alias("node"), F.col("u").alias("component")).where(F.lit(False))
    least = labels.groupBy("component").agg(F.min("node").alias("least"), F.count("*").alias("size"))
    named = attached(labels, least, ["component"], "size", labels.count())
    return write_and_reread(named.select("node", F.col("least").alias("component")), "components")


def merged(components: DataFrame, links: DataFrame) -> DataFrame:
    """The components that ``connected`` would give with further links ``a, b``: only what these join is walked again.

    Besides the links that is one step from each of their ends to the smallest node of its component.
    """
    links = links.select("a", "b")
    ends = links.select("a").union(links.select("b")).distinct().withColumnRenamed("a", "node")
    moved = connected(links.union(components.join(ends, "node").select("node", "component")))
    fresh = moved.join(components, "node", "left_anti")
    sizes = components.groupBy("component").agg(F.count("*").alias("size"))
    steps = sizes.join(moved.select(F.col("node").alias("component"), F.col("component").alias("to")), "component")
    stepped = attached(components, steps, ["component"], "size", components.count(), "left")
    stepped = stepped.select("node", F.coalesce("to", "component").alias("component"))
    return write_and_reread(stepped.unionByName(fresh), "components")
