"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.sources.workdir import materialize


def components(links: DataFrame) -> DataFrame:
    """`node` and `root` for every node of the links (`a`, `b`); roots are nodes.

    Every node is merged into its smallest neighbour and the links are drawn again
    between what is left, until none is. Each round at least halves the nodes of a
    component that is not finished. Every round is written, so a lost executor costs
    at most one round. An empty table of links gives an empty result.
    """
    both = links.select("a", "b").where("a <> b")
    edges = materialize(both.union(both.select("b", "a")).distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        parents = edges.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("root"))
        parents = materialize(parents, "parents")
        if roots is None:
            roots = parents
        else:
            step = parents.select(F.col("node").alias("root"), F.col("root").alias("next"))
            moved = roots.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            roots = materialize(moved, "roots")
        to = parents.withColumnsRenamed({"node": "a", "root": "a_root"})
        fro = parents.withColumnsRenamed({"node": "b", "root": "b_root"})
        drawn = edges.join(to, "a").join(fro, "b").where("a_root <> b_root")
        edges = materialize(drawn.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct(), "edges")
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
