"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerscope.llm.common import drop, stored


def _roots(parents: DataFrame) -> DataFrame:
    """(node, root) from (node, root) with root <= node, by pointer jumping; ``parents`` goes."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("up"))
        jumped = stored(parents.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"), (F.col("up") < F.col("root")).alias("moved")), "jump")
        drop(parents)
        if not jumped.filter("moved").limit(1).count():
            return jumped
        parents = jumped


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): root is one node per component.

    In each round a node hooks on to its smallest neighbour, the trees are flattened, and the
    links are renamed to the roots, until no link is left. Rounds go with the logarithm of
    the longest chain. Nothing is gathered; each round is written to the work folder, and the
    round before deleted.
    """
    edges = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    found = None
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).select(F.col("a").alias("node"), "root")
        roots = _roots(stored(parents, "hooks"))
        a, b = (roots.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
        named = edges.join(a, "a").join(b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        before, edges = edges, stored(named.filter("a <> b").distinct(), "links")
        drop(before)
        if found is None:
            found = roots
        else:
            new = roots.select(F.col("node").alias("root"), F.col("root").alias("new"))
            before, found = found, stored(found.join(new, "root", "left").select("node", F.coalesce("new", "root").alias("root")), "roots")
            drop(before, roots)
    drop(edges)
    return found.select("node", "root") if found is not None else links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
