"""Connected components of an edge table by repeated hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import stored


def _distinct_links(edges: DataFrame, rows: int) -> DataFrame:
    ends = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return stored(ends.filter(F.col("a") < F.col("b")).distinct(), "links", rows)


def _to_roots(parents: DataFrame, rows: int) -> DataFrame:
    """Pointer jumping until every node points to a node that points to itself."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
        jumped = stored(
            parents.join(above, "parent").select(
                "node", F.col("next").alias("parent"), (F.col("next") != F.col("parent")).alias("moved")
            ),
            "parents",
            rows,
        )
        parents = jumped.drop("moved")
        if jumped.filter("moved").isEmpty():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for the nodes of ``edges`` (``a, b`` of one type); the root is the least node.

    Each round hooks every node to its least neighbour and contracts the trees, so long chains and
    stars take few rounds. Nothing is gathered per node: minima are combined on the map side, and
    joins are of stored tables, which AQE can split at a hot node. Tables have files by their number of rows.
    """
    links, labels, all_nodes = _distinct_links(edges, edges.count()), None, 0
    while rows := links.count():
        nodes = 2 * rows  # at most
        all_nodes = all_nodes or nodes
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        roots = _to_roots(
            stored(hooked.select("node", F.least("node", "least").alias("parent")), "hooks", nodes),
            nodes,
        )
        if labels is None:
            labels = roots.withColumnRenamed("parent", "root")
        else:
            step = roots.select(F.col("node").alias("root"), F.col("parent").alias("above"))
            labels = stored(
                labels.join(step, "root", "left").select(
                    "node", F.coalesce("above", "root").alias("root")
                ),
                "labels",
                all_nodes,
            )
        for end in ("a", "b"):
            root_of = roots.select(F.col("node").alias(end), F.col("parent").alias(f"root_{end}"))
            links = links.join(root_of, end)
        links = _distinct_links(links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), rows)
    if labels is None:
        labels = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
