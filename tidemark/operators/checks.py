"""Data checks. Each returns rows (table_name, check_name, column_name, n_bad); `enforce` raises."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Keys, required columns and references of the domain tables.
PRIMARY_KEYS = {
    "customers": "customer_id",
    "subscriptions": "subscription_id",
    "transactions": "transaction_id",
    "support_tickets": "ticket_id",
    "churn_events": "churn_id",
}
REQUIRED_COLUMNS = {
    "customers": ("customer_id", "signup_date"),
    "subscriptions": ("customer_id", "monthly_charges", "tenure_months"),
    "transactions": ("customer_id", "subscription_id", "amount"),
    "support_tickets": ("customer_id", "opened_date"),
    "churn_events": ("customer_id", "churn_date"),
}
# The load stops on the first group; the second is declared in the schema only.
LOADED_REFERENCES = (
    ("subscriptions", "customer_id", "customers"),
    ("transactions", "customer_id", "customers"),
    ("churn_events", "customer_id", "customers"),
)
DECLARED_REFERENCES = (
    ("support_tickets", "customer_id", "customers"),
    ("transactions", "subscription_id", "subscriptions"),
    ("predictions", "customer_id", "customers"),
)


def _union(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def _row(table: str, check: str, column: str):
    return [F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), F.lit(column).alias("column_name")]


def key_check(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows beyond the first of their key; NULL counts as one key."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    surplus = per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("n_bad"))
    return surplus.select(*_row(table, "primary_key", key), "n_bad")


def null_check(df: DataFrame, table: str, columns: tuple[str, ...] | list[str]) -> DataFrame:
    """NULL count of each required column, all in one pass."""
    counts = df.agg(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("n_bad")) for c in columns
    ]).alias("found"))
    return counts.select(F.inline("found")).select(
        F.lit(table).alias("table_name"), F.lit("not_null").alias("check_name"), "column_name", "n_bad"
    )


def reference_check(
    child: DataFrame, child_name: str, column: str, parent: DataFrame, parent_key: str | None = None
) -> DataFrame:
    """Child rows whose reference is missing from the parent, or NULL.

    Both sides are reduced to their keys before the join, so a key with very many rows crosses it
    once.
    """
    per_key = child.groupBy(F.col(column).alias("_key")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key or column).alias("_key")).distinct()
    orphans = per_key.join(known, "_key", "left_anti")
    found = orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_bad"))
    return found.select(*_row(child_name, "reference", column), "n_bad")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ])


def key_report(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([key_check(df, name, PRIMARY_KEYS[name]) for name, df in tables.items()])


def null_report(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([null_check(df, name, REQUIRED_COLUMNS[name]) for name, df in tables.items()])


def table_checks(df: DataFrame, table: str, key: str, required: tuple[str, ...] | list[str]) -> DataFrame:
    """Rows, surplus rows per key and NULLs of a table in one scan and one shuffle of its keys.

    NULLs are counted along with the rows of each key, so a key with very many rows crosses the shuffle once per task.
    """
    found = df.groupBy(key).agg(
        F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(required)]
    )

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")

    checked = [("primary_key", key, total(F.col("_n") - 1))]
    checked += [("not_null", c, total(F.col(f"_null_{i}"))) for i, c in enumerate(required)]
    rows = [
        F.struct(F.lit(check).alias("check_name"), F.lit(column).alias("column_name"), bad.alias("n_bad"))
        for check, column, bad in checked
    ]
    return found.agg(total(F.col("_n")).alias("n_rows"), F.array(*rows).alias("_found")).select(
        F.lit(table).alias("table_name"), F.inline("_found"), "n_rows"
    )


def _references_to(parent: str, tables: dict[str, DataFrame], wanted: list[tuple[str, str]]) -> DataFrame:
    """All references to one parent, whose keys are read once; every child is reduced to its keys first."""
    keys = []
    for child, column in wanted:
        tag = [F.lit(child).alias("table_name"), F.lit(column).alias("column_name")]
        rows = tables[child].groupBy(F.col(column).alias("_key")).agg(F.count("*").alias("n"))
        nothing = rows.sparkSession.range(1).select(*tag, F.lit(None).alias("_key"), F.lit(0).cast("bigint").alias("n"))
        keys += [rows.select(*tag, "_key", "n"), nothing]  # a child without rows is reported as well
    known = tables[parent].select(F.col(wanted[0][1]).alias("_key")).distinct()
    # left, not anti: the join also tells how many rows a child has
    flagged = _union(keys).join(known.withColumn("_known", F.lit(1)), "_key", "left")
    return flagged.groupBy("table_name", "column_name").agg(
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("n_bad"),
        F.sum("n").alias("n_rows"),
    ).select("table_name", F.lit("reference").alias("check_name"), "column_name", "n_bad", "n_rows")


def reference_report(tables: dict[str, DataFrame], declared: bool = True) -> DataFrame:
    """Reference checks of the load, with `declared` also those that only the schema states.

    Parents are read once each, however many tables refer to them.
    """
    return _reference_rows(tables, declared).drop("n_rows")


def _reference_rows(tables: dict[str, DataFrame], declared: bool) -> DataFrame:
    wanted: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for child, column, parent in LOADED_REFERENCES + (DECLARED_REFERENCES if declared else ()):
        if child in tables:
            wanted.setdefault((parent, column), []).append((child, column))
    return _union([_references_to(parent, tables, children) for (parent, _), children in wanted.items()])


def load_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Everything the load insists on, with the rows of each table: no table is scanned more than twice.

    One scan counts rows, NULLs and surplus keys, the other the references, as child or as parent.
    """
    own = [table_checks(df, name, PRIMARY_KEYS[name], REQUIRED_COLUMNS[name]) for name, df in tables.items()]
    return _union([*own, _reference_rows(tables, declared=False)])


def counted_rows(report: DataFrame) -> DataFrame:
    """Rows per table, from a `load_report`."""
    return report.where(F.col("check_name") == "primary_key").select("table_name", "n_rows")


class CheckFailed(ValueError):
    """At least one check found bad rows."""


def enforce(report: DataFrame) -> None:
    """Raise if any check of the report found bad rows; a report has one row per check."""
    bad = report.where(F.col("n_bad") > 0).orderBy("table_name", "check_name", "column_name").collect()
    if bad:
        raise CheckFailed("; ".join(f"{r.table_name}.{r.column_name}: {r.check_name}, {r.n_bad} bad rows" for r in bad))
