"""Tables as Parquet folders: append, and replacement that readers never see half done."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession, types as T

MARKER = "_published"


def append_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Add rows; partition columns become folders that later filters can skip."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Replace a catalogue table hashed and sorted by `key`; joins of such tables on it need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def open_path(spark: SparkSession, path: str, *below: str) -> tuple[JavaObject, JavaObject]:
    """Hadoop path and its file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    for part in below:
        target = hadoop.Path(target, part)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, root: str) -> dict[int, bool]:
    """Version number -> published, for every version folder under `root`."""
    folder, files = open_path(spark, root)
    if not files.exists(folder):
        return {}
    found = {}
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("version="):
            found[int(name.split("=", 1)[1])] = files.exists(open_path(spark, root, name, MARKER)[0])
    return found


def next_version(spark: SparkSession, root: str) -> str:
    """Path of the version after the last one under `root`; a second writer of it fails, as it exists by then."""
    return f"{root}/version={max(_versions(spark, root), default=0) + 1:06d}"


def write_version(df: DataFrame, root: str) -> str:
    """Write the rows as the next version under `root` and return its path; readers do not see it yet."""
    path = next_version(df.sparkSession, root)
    df.write.mode("errorifexists").parquet(path)
    return path


def publish_version(spark: SparkSession, path: str) -> None:
    """Make a written version the current one, by one small file."""
    marker, files = open_path(spark, path, MARKER)
    files.create(marker).close()


def drop_version(spark: SparkSession, path: str) -> None:
    """Delete a version that will not be published."""
    folder, files = open_path(spark, path)
    files.delete(folder, True)


def replace_table(df: DataFrame, root: str) -> str:
    """Write and publish the next version; returns its path.

    Readers keep the former rows until then, a failed write changes nothing, and `df` may read the
    table itself.
    """
    path = write_version(df, root)
    publish_version(df.sparkSession, path)
    return path


def read_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Newest published version."""
    published = [version for version, done in _versions(spark, root).items() if done]
    if not published:
        raise FileNotFoundError(f"no published version under {root}")
    return spark.read.schema(schema).parquet(f"{root}/version={max(published):06d}")
