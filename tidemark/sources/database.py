"""Database tables over JDBC. The caller supplies URL, driver and credentials as options."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_options(
    connection: dict[str, str],
    table: str | None = None,
    query: str | None = None,
    split: tuple[str, str, str, int] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options. `split` = (column, lower, upper, partitions) reads ranges in parallel.

    The bounds only place the cuts; rows outside them are read as well. The split needs a table
    name, so a query is wrapped as a derived table when one is given.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {**connection, "fetchsize": str(fetch_size)}
    if split is None:
        options["dbtable" if table else "query"] = table or query
        return options
    column, lower, upper, partitions = split
    options["dbtable"] = table or f"({query}) part"
    options.update(
        partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions)
    )
    return options


def read_database(spark: SparkSession, connection: dict[str, str], **scan) -> DataFrame:
    return spark.read.format("jdbc").options(**scan_options(connection, **scan)).load()


def write_database(
    df: DataFrame,
    connection: dict[str, str],
    table: str,
    replace: bool = False,
    batch_size: int = 5_000,
    connections: int = 16,
) -> None:
    """Append rows, or empty the table first and keep its definition (`replace=True`).

    `connections` bounds the parallel sessions on the database, not the Spark job.
    """
    (
        df.write.format("jdbc")
        .options(**connection)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .option("numPartitions", connections)
        .option("truncate", replace)
        .mode("overwrite" if replace else "append")
        .save()
    )


def replace_database_tables(tables: dict[str, DataFrame], connection: dict[str, str]) -> None:
    """Empty the tables, children first, and fill them, parents first; `tables` lists parents first.

    Where foreign keys forbid emptying a parent, the URL has to switch the check off for these
    sessions, for MySQL by `sessionVariables=FOREIGN_KEY_CHECKS=0`.
    """
    for name in reversed(tables):
        write_database(tables[name].limit(0), connection, name, replace=True)
    for name, df in tables.items():
        write_database(df, connection, name)
