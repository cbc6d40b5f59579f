"""Reproducible train/test splits and samples, in the order of a key hash."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from tidemark.functions.hashing import key_hash

PREFIX_DIGITS = 4


def _test_quota(per_label: DataFrame, test_size: float) -> DataFrame:
    """Test rows per label: the ceiling of the share overall, dealt out in proportion.

    The train part is dealt by whole shares first and largest fractions next, ties to the smaller
    label; what a label has left is its test part.
    """
    everything = Window.partitionBy()
    total = F.sum("n").over(everything)
    n_train = total - F.ceil(F.lit(float(test_size)) * total)
    share = F.col("n").cast("double") * F.col("n_train") / F.col("total")
    by_fraction = Window.orderBy((F.col("share") - F.floor("share")).desc(), "_label")
    spare = F.col("n_train") - F.sum(F.floor("share")).over(everything)
    return (
        per_label.withColumns({"total": total, "n_train": n_train})
        .withColumn("share", share)
        .withColumns({"spare": spare, "rank": F.row_number().over(by_fraction)})
        .select(
            "_label",
            (F.col("n") - F.floor("share") - F.when(F.col("rank") <= F.col("spare"), 1).otherwise(0)).alias("quota"),
        )
    )


def _cut_offs(light: DataFrame, per_prefix: DataFrame, quota: DataFrame) -> list[Row]:
    """Per label: `last_hash`, the last one that is taken whole, and the next hash with the rows still wanted of it.

    `light` has label, hash and prefix of the rows, `per_prefix` their counts and `quota` the rows wanted per label.
    """
    # At most 16 ** PREFIX_DIGITS rows per label.
    upto = Window.partitionBy("_label").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    last_prefix = (
        per_prefix.join(F.broadcast(quota), "_label")
        .withColumn("reached", F.sum("n").over(upto))
        .where((F.col("reached") >= F.col("quota")) & (F.col("reached") - F.col("n") < F.col("quota")))
        .select("_label", "_prefix", (F.col("quota") - F.col("reached") + F.col("n")).alias("wanted"))
    )
    in_order = Window.partitionBy("_label").orderBy("_hash").rowsBetween(Window.unboundedPreceding, 0)
    before = F.col("reached") - F.col("n")
    whole = F.col("reached") <= F.col("wanted")
    return (
        light.join(F.broadcast(last_prefix), ["_label", "_prefix"])
        .groupBy("_label", "_prefix", "wanted", "_hash")
        .agg(F.count("*").alias("n"))
        .withColumn("reached", F.sum("n").over(in_order))
        .groupBy("_label", "_prefix")
        .agg(
            F.max(F.when(whole, F.col("_hash"))).alias("last_hash"),
            F.min(F.when(~whole & (before < F.col("wanted")), F.struct("_hash", (F.col("wanted") - before).alias("take")))).alias("part"),
        )
        # Without a whole hash to take, the bare prefix sorts before all of its hashes.
        .select("_label", F.coalesce("last_hash", "_prefix").alias("last_hash"), "part._hash", "part.take")
        .collect()
    )


def _counted(hashed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(label, hash and prefix of the rows that a split deals out, their counts per label and prefix)."""
    light = hashed.select("_label", "_hash", F.substring("_hash", 1, PREFIX_DIGITS).alias("_prefix")).where(
        F.col("_label").isin(0, 1) & F.col("_hash").isNotNull()
    )
    return light, light.groupBy("_label", "_prefix").agg(F.count("*").alias("n"))


def _first_rows(rows: DataFrame, take: int) -> DataFrame:
    """Equal rows with `is_test` for the first `take` of them, counted per partition and shifted.

    The generated ids hold the partition in their upper bits and the row's number in it in the lower 33.
    """
    numbered = rows.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
    before = (
        numbered.groupBy("_part")
        .agg(F.count("*").alias("n"))
        .select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    )
    place = F.col("_at").bitwiseAND((1 << 33) - 1) + 1 + F.col("_before")
    return numbered.join(before, "_part").withColumn("is_test", place <= take)


def exact_split(
    df: DataFrame,
    key: str,
    label: str | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    whole_keys: bool = False,
) -> DataFrame:
    """Add `is_test`; per 0/1 label the first rows in hash order form the test part, to the exact count.

    Which rows go to the test part follows from their content and the seed alone.

    Row counts per label and hash prefix tell in which prefix the quota ends; only that prefix is looked at hash by
    hash, which gives one cut-off per label, two rows in all, and the rows are then compared with them. A key that the
    cut falls into is divided the same way, in the order of a hash of the whole row, and what is left of equal rows by
    counting them, so give staged rows when keys repeat. With `whole_keys` all rows of a key share a side instead, and the test part
    may come out smaller by less than that key's rows.
    """
    labels = F.col(label).cast("int") if label else F.lit(0)
    hashed = df.withColumn("_hash", key_hash(key, seed)).withColumn("_label", labels)
    light, per_prefix = _counted(hashed)
    quota = _test_quota(per_prefix.groupBy("_label").agg(F.sum("n").alias("n")), test_size)
    out, divided = _cut(hashed, _cut_offs(light, per_prefix, quota), not whole_keys)
    parts = [out.select(*df.columns, "is_test")]
    row_hash = F.md5(F.concat(F.lit(f"{seed}:"), F.to_json(F.struct(*df.columns))))
    for rows, take in divided:
        by_row = rows.withColumn("_hash", row_hash).withColumn("_label", F.lit(0))
        wanted = df.sparkSession.range(1).select(F.lit(0).alias("_label"), F.lit(take).cast("bigint").alias("quota"))
        in_row_order, equal = _cut(by_row, _cut_offs(*_counted(by_row), wanted), True)
        parts.append(in_row_order.select(*df.columns, "is_test"))
        parts += [_first_rows(same, left).select(*df.columns, "is_test") for same, left in equal]
    return reduce(DataFrame.unionByName, parts)


def _cut(hashed: DataFrame, cuts: list[Row], divide: bool) -> tuple[DataFrame, list[tuple[DataFrame, int]]]:
    """(rows with `is_test` as the cut-offs say, and for each hash that is divided its rows and how many are wanted)."""
    below, divided = F.lit(False), []
    for cut in cuts:
        of_label = F.col("_label") == cut["_label"]
        below = below | (of_label & (F.col("_hash") <= cut["last_hash"]))
        if cut["take"] is not None and divide:
            divided.append((of_label & (F.col("_hash") == cut["_hash"]), cut["take"]))
    is_divided = reduce(Column.__or__, [F.coalesce(rows, F.lit(False)) for rows, _ in divided], F.lit(False))
    whole = hashed.where(~is_divided) if divided else hashed
    return whole.withColumn("is_test", F.coalesce(below, F.lit(False))), [(hashed.where(rows), take) for rows, take in divided]


def sample_rows(df: DataFrame, key: str, n: int = 500, seed: int = 42) -> DataFrame:
    """At most `n` rows without replacement: the first in hash order."""
    return df.withColumn("_hash", key_hash(key, seed)).orderBy("_hash", key).limit(n).drop("_hash")
