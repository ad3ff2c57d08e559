"""Connected components of a table of links, by DataFrame joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyscore.storage import materialize


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component``, the smallest id that links reach, for every id that has a link to another.

    ``links`` has ``a`` and ``b`` (long) in any order, repeated or not; rows with a null or with a = b say nothing.
    Large and small stars take turns (Kiveris et al., 2014): every id hangs its larger, then its smaller neighbours on
    the smallest one, until each id hangs on its component's smallest. The rounds grow with the logarithm of the longest
    path. An id with many links is summed up before it is shuffled; its links are joined as rows, never listed.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = materialize(links, "components")
    before = None
    mark = _mark(links)
    while mark != before and mark[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "components")
        before, mark = mark, _mark(links)
    roots = links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
