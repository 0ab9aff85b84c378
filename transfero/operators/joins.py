"""Join helpers for conditions that are not plain equality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def containment_join(needles: DataFrame, needle: str, hay: DataFrame, text: str) -> DataFrame:
    """Pairs (needle row, hay row) where ``hay[text]`` contains ``needles[needle]``.

    ``contains`` as a join condition is a nested loop over both sides. Instead every text is cut into
    its substrings of the lengths that occur among the needles, and the needles are equi-joined to
    those substrings: a text of n characters yields at most n rows per needle length, and the join is
    a hash join on the substring. The table of needle lengths is bounded by the longest needle, so
    broadcasting it is safe.
    """
    lengths = needles.select(F.length(F.col(needle)).alias("_cj_len")).distinct()
    cut = (hay.crossJoin(F.broadcast(lengths))
           .filter(F.length(F.col(text)) >= F.col("_cj_len"))
           .withColumn("_cj_pos", F.explode(F.sequence(F.lit(1), F.length(F.col(text)) - F.col("_cj_len") + 1)))
           .withColumn("_cj_sub", F.substring(F.col(text), F.col("_cj_pos"), F.col("_cj_len")))
           .drop("_cj_pos", "_cj_len")
           .dropDuplicates())
    return needles.join(cut, needles[needle] == cut["_cj_sub"]).drop("_cj_sub")

