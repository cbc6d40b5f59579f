"""Corpus pipeline: quality rules, near-duplicate removal, benchmark decontamination, secret redaction, packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import decontamination, near_dedup, packing, quality_rules, secret_scan
from tidemark.llm.queries import public_tokenizer
from tidemark.llm.workers import let_workers_import
from tidemark.session import stage_table


def _row(docs: DataFrame) -> Column:
    """The whole row as one column, so that no column of an operator can clash with one of the table."""
    return F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_doc")


def _unfold(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The table's columns again, with some of them changed."""
    return rows.select(*[changed.get(name, F.col("_doc").getField(name)).alias(name) for name in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, with failing lines removed from their text and n_chars set anew.

    Null and empty texts have no words and are rejected. All columns of the input are returned.
    """
    judged = quality_rules.quality_rules(docs.select(_row(docs), "text"))
    # rejected rows give no element; a filter would be pushed below the measures and compute them again inside itself
    kept = judged.select("_doc", F.explode(F.when(F.col("kept"), F.array("clean_text"))).alias("_clean"))
    return _unfold(kept, docs, text=F.col("_clean"), n_chars=F.length("_clean").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id, and one of repeated rows.

    A row without id goes if it is a copy of one with an id, and stays otherwise.
    """
    let_workers_import(spark)
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("_text_hash"))
    groups = stage_table(near_dedup.near_duplicates(hashed, carry=["_text_hash"]), "groups")
    dropped = groups.where("not kept").select(F.col("doc_id").alias("_id"), F.col("_text_hash").alias("_hash")).distinct()
    keyed = docs.select(_row(docs), "doc_id", F.xxhash64("text").alias("_text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    left = keyed.join(dropped, same, "left_anti")
    repeated = groups.where("kept and doc_id is not null").groupBy("doc_id", "_text_hash").count().where("count > 1")
    if not repeated.isEmpty():
        with_id = left.where("doc_id is not null").dropDuplicates(["doc_id", "_text_hash"])
        left = with_id.unionByName(left.where("doc_id is null"))
    return _unfold(left, docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, in its own words or with other numbers, names or units.

    Rows are told apart by a hash of id and text, so that rows without id are examined too.
    """
    let_workers_import(spark)
    key = F.xxhash64("doc_id", "text").alias("_key")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = decontamination.find_leaks(docs.select(key, "text"), benchmark, id_col="_key")
    leaked = leaks.select(F.col("doc_id").alias("_key")).distinct()
    return _unfold(docs.select(_row(docs), key).join(leaked, "_key", "left_anti"), docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a placeholder and n_chars set anew where the text changed."""
    ratios = secret_scan.train(secret_scan.labelled_samples(spark))
    found = secret_scan.scan_secrets(docs.select(_row(docs), "text"), ratios)
    redacted = secret_scan.redact(found.withColumn("_changed", F.size("secret_spans") > 0))
    counted = F.when(F.col("_changed"), F.length("text").cast("long")).otherwise(F.col("_doc").getField("n_chars"))
    return _unfold(redacted, docs, text=F.col("text"), n_chars=counted)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenized documents with their places in sequences of 2048 tokens."""
    let_workers_import(spark)
    return packing.pack_documents(docs, public_tokenizer())


STAGES = [
    ("quality_rules", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

#: Signatures, tokenizers and linear programs are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage; each stage reads what the one before has written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
