"""Connected components of a link table, without bringing links or components to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundmill.runtime import cut


def components(links: DataFrame, *, max_rounds: int = 40) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest id that can be reached.

    Each round takes the least label among the neighbours and then the label of that label, so a chain of n
    links needs about log n rounds. Labels are cut after every round. Null ends are left out.
    """
    both = cut(links.where("a is not null and b is not null and a <> b").select("a", "b").unionByName(links.where("a is not null and b is not null and a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")))
    for _ in range(max_rounds):
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        stepped = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("far"))
        moved = cut(stepped.join(jump, "component", "left").select("id", "old", F.least("component", F.coalesce("far", "component")).alias("component")))
        done = moved.where("old <> component").limit(1).count() == 0
        labels = moved.select("id", "component")
        if done:
            return labels
    raise RuntimeError(f"labels still changed after {max_rounds} rounds")
