"""Session defaults and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_own_folders: dict[str, str] = {}
_written: list[str] = []


def local_session(cores: str = "8", name: str = "docmill") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def work_dir(spark: SparkSession, purpose: str) -> str:
    """New folder for written intermediate tables, under the shared folder of the cluster.

    A local session that names no shared folder (tests) gets one of its own, removed when the
    process ends. Elsewhere such a session is an error: executors would write to their own disks.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None) or _own_folder(spark)
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def _own_folder(spark: SparkSession) -> str:
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="docmill-", dir="/tmp")
        atexit.register(shutil.rmtree, _own_folders[application], ignore_errors=True)
    return _own_folders[application]


def written_so_far() -> int:
    """A mark for ``remove_written``."""
    return len(_written)


def remove_written(spark: SparkSession, since: int = 0, keep: Sequence[str] = ()) -> None:
    """Delete the work folders of this process (those made since a mark, but for the kept ones), in whatever store they are.
    For the end of a job or of a step: frames that read them can no longer be used."""
    for folder in [p for p in _written[since:] if p not in keep]:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        _written.remove(folder)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Store an intermediate result in the shared folder and read it back.

    For results used several times: they are computed once, and losing an executor later costs
    nothing, as the files stay.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
