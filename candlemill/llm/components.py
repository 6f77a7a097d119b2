"""Connected components of a graph of links, by alternating star contractions."""

from pyspark.sql import functions as F

from candlemill.llm.common import staged


def _hooked(edges):
    """Every node is tied to the least node among itself and its neighbours.

    The least neighbour is an aggregate, so a node with very many links is harmless,
    and joining it back is an ordinary join that Spark can split where a key is hot.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.join(least, "a")


def _large_star(edges):
    rows = _hooked(edges).filter("b > a")
    return rows.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a != b").distinct()


def _small_star(edges):
    """``edges`` run from a larger node a to a smaller node b."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    down = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return down.union(least.select("a", F.col("least").alias("b"))).filter("a != b").distinct()


def _state(edges):
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected(links):
    """Rows ``(node, component)`` for every node of the links (columns ``a``, ``b``).

    A component is named by its least node. Each round is written to the shared folder;
    the number of rounds grows with the logarithm of the size of the largest component.
    Empty links give no rows; repeated links, loops and NULL ends are harmless.
    """
    edges = links.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a != b")
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = staged(edges.distinct(), "links")
    before = None
    while (now := _state(edges)) != before:
        before = now
        if not now[0]:
            break
        edges = staged(_small_star(_large_star(edges)), "links")
    tied = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return tied.union(roots)
