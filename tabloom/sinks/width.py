"""How many tasks write."""

from __future__ import annotations

from pyspark.sql import DataFrame


def output_width(df: DataFrame, partitions: int | None, shuffle: bool = False) -> DataFrame:
    """At most ``partitions`` output tasks; None leaves the number to Spark.

    ``coalesce`` adds no shuffle but also narrows the stage that computes the rows, so a small
    number over a heavy plan should come with ``shuffle=True``.
    """
    if partitions is None:
        return df
    return df.repartition(partitions) if shuffle else df.coalesce(partitions)
