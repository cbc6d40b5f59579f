"""Session defaults and the shared folder for data that outlives one job."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.util import inheritable_thread_target

Result = TypeVar("Result")

#: Tasks of a forest fit that are enough for a usual cluster, and the rows beyond which a task is divided again.
FOREST_TASKS, FOREST_ROWS_PER_TASK = 48, 50_000

#: The same for fits of many short jobs (boosting, regression), whose rows per task start at FIT_ROWS_PER_TASK.
FIT_TASKS, FIT_ROWS_PER_TASK, MOST_FIT_ROWS_PER_TASK = 24, 20_000, 200_000

#: MB of sums that one job of a forest fit gathers per task: usual, and beyond so many rows.
FOREST_GROUP_MB, FULL_FOREST_GROUP_MB, FOREST_GROUP_ROWS = 256, 1, 480_000


def build_session(app_name: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings the jobs are tuned for; `settings` win over the defaults.

    Cluster size, memory and `spark.checkpoint.dir` belong to spark-submit and are left alone.
    """
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    elif not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return (folder or context.getCheckpointDir()).rstrip("/")


def _stage_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tidemark-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """Unused path in the shared folder, below a folder of this application."""
    return f"{_stage_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_stage(spark: SparkSession) -> None:
    """Delete everything this application staged; call it when results are stored elsewhere."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_stage_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage in one pass; the copy survives lost executors, and iterative fits that read
    it get column pruning from Parquet.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, n_rows: int, rows_per_task: int = 20_000) -> DataFrame:
    """Rows in partitions whose number, content and order follow from the rows alone.

    Model fits draw samples per partition, so the same rows have to meet the same draws on any cluster.
    """
    columns = [F.col(f"`{name}`") for name in df.columns if not isinstance(df.schema[name].dataType, VectorUDT)]
    return df.repartition(n_rows // rows_per_task + 1, *columns).sortWithinPartitions(*columns)


def forest_rows_per_task(n_rows: int) -> int:
    """Rows per task of a forest fit, for `spread`.

    A row costs a forest far more than other fits, as all trees grow at once, so few rows fill a task. But every task
    also sends one set of sums per open node of every tree, however few rows it has, so beyond FOREST_TASKS tasks they
    get more rows instead, and there are more tasks only where one would hold over FOREST_ROWS_PER_TASK.
    """
    return min(max(500, n_rows // FOREST_TASKS + 1), FOREST_ROWS_PER_TASK)


def forest_group_mb(n_rows: int) -> int:
    """MB of sums that one job of a forest fit gathers per task, which bounds the trees that grow in that job.

    A row passes all trees of a job before the next row does. With hundreds of trees at once, their nodes and sums are
    pushed out of the processor's cache between two rows, and a tree costs twice what it costs among few. With few rows
    the jobs themselves cost more than that. The order in which nodes draw their columns follows from this number.
    """
    return FOREST_GROUP_MB if n_rows <= FOREST_GROUP_ROWS else FULL_FOREST_GROUP_MB


def fit_rows_per_task(n_rows: int) -> int:
    """Rows per task of a fit that is a long series of short jobs, for `spread`.

    Each job waits for the one before, and every one of its tasks costs the same however few rows it has, on the map and
    on the reduce side. So beyond FIT_TASKS tasks they get more rows instead, and there are more tasks only where one
    would hold over MOST_FIT_ROWS_PER_TASK.
    """
    return min(max(FIT_ROWS_PER_TASK, n_rows // FIT_TASKS + 1), MOST_FIT_ROWS_PER_TASK)


def side_by_side(spark: SparkSession, fits: list[Callable[[], Result]], workers: int = 4) -> list[Result]:
    """Run independent model fits at the same time, so that their many short jobs fill the cluster."""
    tagged = [inheritable_thread_target(spark)(fit) for fit in fits]
    with ThreadPool(min(workers, len(fits))) as pool:
        return pool.map(lambda fit: fit(), tagged)
