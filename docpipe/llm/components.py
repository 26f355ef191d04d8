"""Connected components of a table of links, by rounds of joins that keep hubs small."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpipe.llm.common import dropped, kept


def _state(links: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), digest).first())


def components(links: DataFrame) -> DataFrame:
    """`node` and `root`, the least node of its component, for each node of the links `u`, `v`.

    Each round ties the larger neighbours of a node to its least one, then the smaller ones; all
    links of a component end up as a star around its least node, in a number of rounds that grows
    with the logarithm of its size. A node with very many links is one row of an aggregate
    and the short side of a join. Repeated links and links of a node to itself do no harm; no
    links give no rows.
    """
    links = links.where("u <> v")
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = kept(links, "links")
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        # the larger neighbours of u go to the least node around u
        larger = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        larger = larger.where("u <> v").distinct()
        # what is left of u goes to its least smaller neighbour, and these to each other
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        tied = larger.join(least, "u")
        smaller = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        own = least.select("u", F.col("m").alias("v"))
        before, links = links, kept(smaller.unionByName(own).distinct(), "links")
        dropped(before)
        now = _state(links)
        if now == state:
            break
        state = now
    ends = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return ends.unionByName(ends.select(F.col("root").alias("node"), "root").distinct())
