"""Connected components by smallest label, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``v, c``: the smallest vertex of the component of every vertex in ``edges`` (a, b: long).

    Each round takes the smallest label of the neighbours, then the label of the label. Rounds grow with
    the logarithm of the longest path; only the number of changed labels comes to the driver.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    both = store(spark, both, f"{label}-edges")
    labels = store(spark, both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("c")), f"{label}-0")
    while True:
        near = both.join(labels, F.col("b") == F.col("v")).groupBy("a").agg(F.min("c").alias("m"))
        lower = labels.join(near, F.col("v") == F.col("a")).select("v", "c", F.least("c", "m").alias("n"))
        jump = labels.select(F.col("v").alias("u"), F.col("c").alias("up"))
        step = lower.join(jump, F.col("n") == F.col("u"), "left").select("v", F.least("n", F.coalesce("up", "n")).alias("c"), (F.least("n", F.coalesce("up", "n")) < F.col("c")).alias("moved"))
        step = store(spark, step, f"{label}-round")
        if not step.filter("moved").limit(1).count():
            return step.select("v", "c")
        labels = step.select("v", "c")
