"""The batch operators run over a stream of new pages and deals: each micro-batch is one upsert into a snapshot."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

Merge = Callable[[DataFrame, DataFrame], DataFrame]


class Snapshots:
    """A table as numbered snapshots in a shared folder: a new one is written whole, then named as the current one, so a
    reader never sees half of it and a batch that is run again changes nothing."""

    def __init__(self, spark: SparkSession, root: str, schema: str) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def _fs(self):  # noqa: ANN202
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Finished snapshots, those with their success mark."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = self._fs()
        if not fs.exists(path(self.root)):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path(self.root)) if s.isDirectory()]
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and fs.exists(path(f"{self.root}/{n}/_SUCCESS")))

    def read(self, before: int | None = None) -> DataFrame:
        known = [v for v in self.versions() if before is None or v < before]
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/v{known[-1]}") if known else self.spark.createDataFrame([], self.schema)

    def write(self, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/v{version}")


def merge_into(snapshots: Snapshots, merge: Merge) -> Callable[[DataFrame, int], None]:
    """The function for ``foreachBatch``: batch n makes snapshot n + 1 from the latest before it."""

    def run(batch: DataFrame, number: int) -> None:
        snapshots.write(merge(snapshots.read(before=number + 1), batch), number + 1)

    return run


def upsert_stream(stream: DataFrame, snapshots: Snapshots, merge: Merge, checkpoint: str) -> DataStreamWriter:
    return stream.writeStream.foreachBatch(merge_into(snapshots, merge)).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def first_seen(stream: DataFrame, key: str, time: str, delay: str = "7 days") -> DataFrame:
    """Rows whose key wasn't seen within the delay; state is dropped once the watermark passes."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def daily_totals(stream: DataFrame, time: str, group: str, value: str, delay: str = "7 days") -> DataFrame:
    """Counts and sums per day and group with late rows up to the delay."""
    day = F.window(time, "1 day")
    return stream.withWatermark(time, delay).groupBy(day, group).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("day"), group, "n", "total")
