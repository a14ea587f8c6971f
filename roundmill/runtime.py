"""Session helpers: reading tables, cutting lineage in the shared folder, size-checked broadcasts."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named table, narrowed to the columns given so that the scan reads no others."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only where none is set and all runs on one machine, as in tests."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not shared:
        shared = context._jsc.sc().getCheckpointDir()
        shared = shared.get() if shared.isDefined() else None
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="roundmill-")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared)
    return shared


def cut(df: DataFrame, *, eager: bool = True) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out over all cores where the scan has fewer partitions than there are cores, as with one small file;
    otherwise the scan as it is, without a shuffle. For work that costs far more than moving its rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def stored_rows(df: DataFrame) -> int:
    """Rows of a frame that ``cut`` gave: its stored rows are counted in one job, without the plan and the exchange that a count has."""
    return df._jdf.queryExecution().toRdd().count()


def broadcast_if_small(df: DataFrame, max_rows: int, rows: int | None = None) -> DataFrame:
    """Hint a broadcast only when a count proves the bound; otherwise leave the choice to the planner.

    The count stops after ``max_rows + 1`` rows; it isn't made where ``rows`` says how many there are.
    """
    if rows is None:
        rows = df.limit(max_rows + 1).count()
    return F.broadcast(df) if rows <= max_rows else df


def collect_bounded(df: DataFrame, max_rows: int, what: str) -> list:
    """Collect a statistic whose size is bounded by its definition; refuse anything larger."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what}: more than {max_rows} rows, which its definition rules out")
    return rows


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, so that Python workers find it wherever they run; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent).as_posix())
    shared = urlparse(checkpoint_dir(spark))
    folder = Path(shared.path) if shared.scheme in ("", "file") else Path(tempfile.mkdtemp())
    folder.mkdir(parents=True, exist_ok=True)
    place = folder / f"roundmill-{context.applicationId}.zip"
    place.write_bytes(data.getvalue())
    context.addPyFile(str(place))
    _shipped.add(context.applicationId)
