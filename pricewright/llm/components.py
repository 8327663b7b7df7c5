"""Connected components of a large graph, in rounds of joins and minima."""

from pyspark.sql import DataFrame, functions as F

from .base import stage


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Rows (node, root) for every node of ``edges``; the root is the smallest node of the component.

    Every node points at a node of its component, at first at its smallest neighbour.
    In each round it takes over the smallest grandparent among its neighbours, hands
    that to its parent, and skips a generation, so rounds grow with the
    logarithm of the longest path. Minima combine before they are shuffled, and both sides of every
    join are stored tables, so adaptive execution can split a hot key.
    Self links count as nodes; links with a null end do not count.
    """
    ends = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a is not null and b is not null")
    both = stage(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    state = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("parent")), "parents")

    def total(table):
        return table.agg(F.sum(F.col("parent").cast("decimal(38,0)"))).first()[0]

    before = total(state)
    while before is not None:
        parents = state.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        grand = stage(state.join(parents, "parent"), "grandparents")
        nearest = both.join(grand.select(F.col("node").alias("b"), "grand"), "b").groupBy(F.col("a").alias("node")).agg(F.min("grand").alias("least"))
        nearest = stage(nearest, "nearest").join(grand.select("node", "parent", "grand"), "node")
        handed = F.array(
            F.struct("node", F.least("least", "grand").alias("parent")),
            F.struct(F.col("parent").alias("node"), F.col("least").alias("parent")),
        )
        moves = nearest.select(F.inline(handed))
        state = stage(moves.groupBy("node").agg(F.min("parent").alias("parent")), "parents")
        now = total(state)
        if now == before:
            break
        before = now
    return state.select("node", F.col("parent").alias("root"))
