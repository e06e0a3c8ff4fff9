"""Connected components of a link table, by alternating large and small stars.

Every round is a few joins on vertex ids, written below the shared folder, so a
lost executor costs at most one round and no lineage grows.  Hubs are summed
map-side (min per vertex) and then joined, which adaptive execution can split;
no vertex's links are gathered in one task.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select(F.explode(F.array(
        F.struct(F.col("u"), F.col("m")), F.struct(F.col("v").alias("u"), F.col("m")))).alias("e")) \
        .select("e.u", F.col("e.m").alias("v"))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex in ``links`` (u, v); root is the least vertex of the component.

    Self-links and repeated links do no harm; an empty table gives an empty result.
    """
    at = materialise(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                     .distinct(), "links")
    before = _state(at)
    while before[0]:
        at = materialise(_small_star(_large_star(at)).where("u <> v").distinct(), "links")
        now = _state(at)
        if now == before:
            break
        before = now
    return at.select(F.col("u").alias("vertex"), F.col("v").alias("root")) \
        .union(at.select(F.col("v"), F.col("v"))).distinct()
