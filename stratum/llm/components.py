"""Connected components of a link table, as distributed joins.

Alternating star contraction: a large star hangs all larger neighbours of a node on
the smallest node around it, a small star does the same with the node and its smaller
neighbours.  Both keep the components and make the graph shallower; after O(log n)
rounds every node hangs on the smallest of its component.  Each step is an aggregate
(combined before the shuffle, so a node with very many links is no hot group) and a
join on the same key, which adaptive execution splits where one key dominates.
Every round is stored, so a lost executor does not repeat earlier ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.frames import stored


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """``links``: (u, v) with u > v.  Returns links of the same form."""
    if large:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    met = both.join(low, "u")
    if large:
        out = met.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("m").alias("v"))
    return out.filter(F.col("u") > F.col("v")).distinct()


def connected(links: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """(id, component) of every node with a link to another; component = smallest id.

    ``links`` has two columns of ids; self links, nulls and repeated links are allowed.
    """
    a, b = links.columns
    e = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = stored(e, f"{name}-links")
    mark = None
    for _ in range(rounds):
        e = stored(_stars(_stars(e, True), False), f"{name}-stars")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())
        if now == mark or not now[0]:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
        mark = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
