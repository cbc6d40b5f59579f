"""CSV, JSON and text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.schemas import MODEL_METADATA


#: Stands for a quoted empty field while a file is read, so that it is told apart from a missing one.
_EMPTY = "\x01"


def _exact_number(name: str, kind: T.DataType) -> Column:
    """A number read as text, as its type; a value that the type cannot hold exactly stops the read."""
    text = F.col(name)
    value = text.try_cast("decimal(38,18)")
    fits = value.try_cast(kind.simpleString())
    what = kind.simpleString() if isinstance(kind, T.DecimalType) else "whole number"
    wrong = F.raise_error(F.concat(F.lit(f"{name} is no {what}: "), text)).cast(kind)
    return F.when(text.isNull(), F.lit(None).cast(kind)).when(value == fits, fits).otherwise(wrong)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = False) -> DataFrame:
    """Header CSV with a declared schema; dates as yyyy-MM-dd, missing fields as NULL, quoted empty text as empty text.

    A value that does not fit its type, or a header that differs from the schema, stops the read
    instead of turning into NULL, losing digits or landing in the wrong column. Whole numbers
    may be written with a zero fraction ("4.0"), as data frame libraries do for columns with gaps.
    Quoted fields may hold line breaks only with `line_breaks`, as such files can't be read in parts.
    """
    exact = (T.IntegerType, T.LongType, T.DecimalType)
    in_file = T.StructType(
        [T.StructField(f.name, T.StringType() if isinstance(f.dataType, exact) else f.dataType) for f in schema]
    )
    rows = (
        spark.read.schema(in_file)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("emptyValue", _EMPTY)
        .option("multiLine", line_breaks)
        .csv(path)
    )

    def column(f: T.StructField) -> Column:
        if isinstance(f.dataType, exact):
            return _exact_number(f.name, f.dataType).alias(f.name)
        if isinstance(f.dataType, T.StringType):
            return F.when(F.col(f.name) == _EMPTY, "").otherwise(F.col(f.name)).alias(f.name)
        return F.col(f.name)

    return rows.select([column(f) for f in schema])


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Header CSV, one file per partition, quotes doubled inside quoted fields."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_text(spark: SparkSession, lines: list[str], path: str, mode: str = "errorifexists") -> None:
    """Short report as one text file; `lines` are the rendered results of a few tests."""
    rows = [(line,) for line in lines]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode(mode).text(path)


def write_metadata(
    spark: SparkSession, path: str, best_model: str, categorical: list[str], numeric: list[str], model_version: str
) -> None:
    """One JSON row that tells scoring jobs which model and which columns to use."""
    row = [(best_model, list(categorical), list(numeric), model_version)]
    spark.createDataFrame(row, MODEL_METADATA).coalesce(1).write.mode("overwrite").json(path)


def read_metadata(spark: SparkSession, path: str) -> dict:
    return spark.read.schema(MODEL_METADATA).json(path).first().asDict()
