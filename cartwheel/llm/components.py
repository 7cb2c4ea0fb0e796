"""Connected components of a table of links, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(v, comp) for every end of the links (a, b); comp is the smallest v that can be reached.

    Each round takes the smallest label among the neighbours and then that label's own label, so a chain halves with
    every round and a star is done after two. Labels and links stay in tables; only a count reaches the driver.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "comp"), "b").groupBy(F.col("a").alias("v")).agg(F.min("comp").alias("near"))
        lower = labels.join(near, "v").select("v", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        onward = labels.select(F.col("v").alias("comp"), F.col("comp").alias("further"))
        new = stored(lower.join(onward, "comp", "left").select("v", "old", F.least("comp", F.coalesce("further", "comp")).alias("comp")), "labels")
        labels = new.select("v", "comp")
        if new.where("comp <> old").isEmpty():
            return labels
