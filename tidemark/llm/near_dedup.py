"""Near-duplicate documents: SuperMinHash signatures, banding, exact verification, union-find grouping."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.superminhash import band_keys, signatures
from tidemark.llm.words import find_words, shingle_sets, text_chunks, word_hashes
from tidemark.session import stage_table

SHINGLE_WORDS = 5
#: Two sets are linked if 100 * their intersection >= LINK_PERCENT * their union.
LINK_PERCENT = 85
#: At similarity 0.85 a pair shares none of 28 bands of 6 ranks in about 2 of a million cases.
BANDS, ROWS_PER_BAND = 28, 6
#: Members of a bucket that are held together; larger buckets are compared block by block.
BLOCK_MEMBERS = 256
_COLUMNS_AT_ONCE = 4096
#: Bits of the filter that spares texts outside all buckets the second reading; a full filter spares none.
FILTER_BITS = 1 << 23


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, ...) -> (doc_id, n_shingles, digest of the set, band keys, ...)."""
    for batch in batches:
        for first, last, data, offsets in text_chunks(batch.column(1)):
            words = find_words(data, offsets)
            sets = shingle_sets(words, word_hashes(words), SHINGLE_WORDS)
            keys = band_keys(signatures(sets, BANDS * ROWS_PER_BAND), ROWS_PER_BAND)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, last - first),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1))
                    ),
                    *[c.slice(first, last - first) for c in batch.columns[2:]],
                ],
                ["doc_id", "n_shingles", "digest", "bands", *batch.schema.names[2:]],
            )


def _packed_sets(wanted: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, text, place) -> (rep, its sorted shingles as bytes) of rows whose place is set in the filter `wanted`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(2).to_numpy()
            passed = (wanted[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1)
            batch = batch.filter(pa.array(passed.astype(bool)))
            for first, last, data, offsets in text_chunks(batch.column(1)):
                words = find_words(data, offsets)
                sets = shingle_sets(words, word_hashes(words), SHINGLE_WORDS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["rep", "shingles"],
                )

    return run


def _place(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def _filter_of(keys: DataFrame, key: str) -> np.ndarray:
    """Filter of FILTER_BITS bits with the places of all keys set; its size does not depend on their number."""
    bits = keys.select(_place(key).alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")
    )
    out = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    for r in bits.collect():
        out[r["word"]] = r["bits"] % 2**64
    return out


def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of some sets, by products of 0/1 matrices over the elements that sets share."""
    n = len(sets)
    if n == 2:
        size = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), size], [size, len(sets[1])]])
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    elements, where, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    column = (np.cumsum(shared) - 1)[where]
    keep = shared[where]
    owner, column = owner[keep], column[keep]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((n, n), dtype=np.float32)
    for low in range(0, int(shared.sum()), _COLUMNS_AT_ONCE):
        a, b = np.searchsorted(column, [low, low + _COLUMNS_AT_ONCE])
        part = np.zeros((n, min(_COLUMNS_AT_ONCE, int(column[b - 1]) - low + 1)), dtype=np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return np.rint(out).astype(np.int64)


def _verified(table: pa.Table) -> pa.Table:
    """Links of one pair of blocks, as a forest: links within what is connected already are left out."""
    reps = table.column("rep").to_numpy()
    sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("shingles").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    common = _common(sets)
    union = sizes[:, None] + sizes[None, :] - common
    left, right = np.nonzero(np.triu(100 * common >= LINK_PERCENT * union, 1))
    parent = list(range(len(reps)))
    kept = []
    for a, b in zip(left.tolist(), right.tolist()):
        x, y = _find(parent, a), _find(parent, b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    pairs = np.array(kept, dtype=np.int64).reshape(-1, 2)
    return pa.table({"u": pa.array(reps[pairs[:, 0]]), "v": pa.array(reps[pairs[:, 1]])})


def _block_pairs(representatives: DataFrame) -> DataFrame:
    """(task, rep): the members of every bucket, once for each pair of blocks of the bucket that must be compared.

    A bucket is a key, which the band is part of. Buckets of one block that have equal members, as copies have in most bands, are compared once.
    """
    entries = representatives.select("rep", F.explode("bands").alias("key"))
    sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = entries.join(sizes, "key")
    small = (
        members.where(F.col("members") <= BLOCK_MEMBERS)
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("rep")).alias("reps"))
        .groupBy(F.xxhash64("reps").alias("bucket"), F.hash("reps").alias("i"))
        .agg(F.first("reps").alias("reps"))
        .select(F.struct("bucket", "i", F.lit(-1).alias("j")).alias("task"), F.explode("reps").alias("rep"))
    )
    blocks = F.ceil(F.col("members") / BLOCK_MEMBERS).cast("int")
    large = members.where(F.col("members") > BLOCK_MEMBERS).select(
        "key", "rep", blocks.alias("blocks"), F.pmod(F.xxhash64("rep"), blocks.cast("long")).cast("int").alias("block")
    )
    # a task of two blocks also compares the pairs inside each of them
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("block != other").select(
        F.struct(
            F.col("key").alias("bucket"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
        ).alias("task"),
        "rep",
    )
    return small.unionByName(large)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row, and the whole numbers of the columns in `carry`.

    A document is the set of its distinct five-word shingles. Rows with equal sets (copies) become one representative,
    the least id. Representatives that share a band of their SuperMinHash signature meet in a bucket; all pairs of a
    bucket are confirmed on full sets, inside a task and block by block, and only a forest of links leaves the task.
    Links are grouped to components; `component_id` is the least id reachable and `kept` marks that document.

    Null and empty texts have an empty set, are linked with nothing and are kept. Repeated rows are copies: those with
    the least id are all kept. A row without id joins its copies; alone it stands for itself, with a null component
    and kept. Extra columns are ignored; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    carried = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *carry)
    extra = "".join(f", `{name}` long" for name in carry)
    sketches = stage_table(
        carried.mapInArrow(_sketches, f"doc_id long, n_shingles long, digest binary, bands array<long>{extra}"), "sketches"
    )
    representatives = (
        sketches.where("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"))
    )
    representatives = stage_table(representatives, "representatives")
    banded = representatives.select(F.col("rep").alias("doc_id"), "digest").join(
        sketches.select("doc_id", "digest", "bands").dropDuplicates(["doc_id", "digest"]), ["doc_id", "digest"]
    )
    tasks = stage_table(_block_pairs(banded.select(F.col("doc_id").alias("rep"), "bands")), "buckets")
    wanted = tasks.select("rep").distinct()
    second = source.where("doc_id is not null").withColumn("place", _place("doc_id"))
    sets = stage_table(
        second.mapInArrow(_packed_sets(_filter_of(wanted, "rep")), "rep long, shingles binary")
        .join(wanted, "rep", "left_semi")
        .dropDuplicates(["rep", "shingles"]),
        "sets",
    )
    links = tasks.join(sets, "rep").groupBy("task").applyInArrow(_verified, "u long, v long")
    components = connected_components(links)
    groups = representatives.join(components, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id")
    )
    out = sketches.drop("bands").join(groups, "digest", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.col("component_id").isNull()).alias("kept"),
        *carry,
    )
