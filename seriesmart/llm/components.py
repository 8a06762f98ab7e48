"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmart.llm.common import stored


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(v, label) of every end of a link (a, b): the least vertex that can be reached.

    Each round a vertex takes the least label among itself, its neighbours and its label's label, so
    long paths shorten by halves. Rounds are written tables; the driver sees one count of each.
    """
    both = stored(spark, links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    labels = stored(spark, labels, "labels")
    while True:
        near = (
            both.join(labels.select(F.col("v").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("v"))
            .agg(F.min("label").alias("near"))
        )
        low = labels.join(near, "v").select("v", "label", F.least("label", "near").alias("low"))
        up = labels.select(F.col("v").alias("low"), F.col("label").alias("up"))
        new = low.join(up, "low").select("v", F.col("label").alias("old"), F.least("low", "up").alias("label"))
        new = stored(spark, new, "labels")
        changed = new.filter("label <> old").limit(1).count()
        labels = new.select("v", "label")
        if not changed:
            return labels
