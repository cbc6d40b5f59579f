"""Hard-negative mining: exact lists of the best rows per anchor, with bounds carried along a spanning tree of anchors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import new_path, stage_table

#: Anchors that share one tree.
TREE_ANCHORS = 256
#: Bytes of anchors that one pass over the rows takes along; it bounds what the driver and each task hold of them.
PASS_BYTES = 8_000_000
#: Rows that are bounded and scored together.
ROWS_AT_ONCE = 4096
#: Components are scaled by this and rounded down.
SCALE = 256
#: Scaled components count as this at most, so that scores of vectors of up to 127 components fit 64 bits.
MAX_COMPONENT = 1 << 28
_CELL_BITS = 16
_EXACT = float(1 << 53)


class Tree(NamedTuple):
    """Anchors in an order in which each comes after its parent; `edge[i]` is the distance to `parent[i]`."""

    class_ids: list[int]
    labels: np.ndarray
    vectors: np.ndarray
    parent: np.ndarray
    edge: np.ndarray


class Block(NamedTuple):
    """Candidates: label, vector and norm of each class, and the ids of its rows in flat form."""

    labels: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    first: np.ndarray
    ids: np.ndarray


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of whole numbers as rows of a matrix; shorter ones are filled up with zeros."""
    column = column.cast(pa.list_(pa.int64()))
    lengths = np.diff(column.offsets.to_numpy())
    width = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))


def _scores(vectors: np.ndarray, norm: float, anchor: np.ndarray, anchor_norm: float) -> np.ndarray:
    """Inner products as 64-bit numbers, in floating point where that is exact."""
    width = min(vectors.shape[1], len(anchor))
    left, right = vectors[:, :width], anchor[:width]
    if norm * anchor_norm < _EXACT:  # bounds every partial sum, too
        return (left.astype(np.float64) @ right.astype(np.float64)).astype(np.int64)
    return left @ right


def spanning_tree(class_ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Tree:
    """Minimum spanning tree by Prim's method; the root is the anchor nearest to the mean."""
    floats = vectors.astype(np.float64)
    squares = (floats**2).sum(axis=1)
    start = int(((floats - floats.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order, parent_of = [start], np.zeros(len(labels), dtype=np.int64)
    near = squares + squares[start] - 2 * (floats @ floats[start])
    near[start] = np.inf
    nearest = np.full(len(labels), start)
    for _ in range(len(labels) - 1):
        new = int(near.argmin())
        parent_of[new] = nearest[new]
        order.append(new)
        away = squares + squares[new] - 2 * (floats @ floats[new])
        closer = (away < near) & ~np.isinf(near)
        near[closer], nearest[closer] = away[closer], new
        near[new] = np.inf
    place = np.empty(len(labels), dtype=np.int64)
    place[order] = np.arange(len(order))
    edges = _norms(floats[order] - floats[parent_of[order]])
    edges[0] = 0
    return Tree(class_ids[order].tolist(), labels[order], vectors[order], place[parent_of[order]], edges)


def _walk(
    tree: Tree, norms: np.ndarray, block: Block, floor: np.ndarray, ceiling: np.ndarray, same: bool
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows, their scores) for all rows whose score may lie between the anchor's `floor` and `ceiling`.

    A child's score differs from its parent's by at most the edge times the row's norm. Rows whose bounds miss the
    window of an anchor are not scored; their bounds, wider by the edge, go on to the anchor's children. The caller may
    narrow `floor` meanwhile.
    """
    low = np.empty((len(tree.edge), len(block.norms)))
    high = np.empty_like(low)
    largest = float(block.norms.max(initial=0))
    slack = 1e-6 + 1e-12 * block.norms * float(norms.max(initial=0))
    for k, edge in enumerate(tree.edge):
        if k == 0:
            low[0] = high[0] = all_scores = _scores(block.vectors, largest, tree.vectors[0], norms[0])
        else:
            reach = (1 + 1e-9) * edge * block.norms + slack
            np.subtract(low[tree.parent[k]], reach, out=low[k])
            np.add(high[tree.parent[k]], reach, out=high[k])
        wanted = (block.labels == tree.labels[k]) == same
        wanted &= (high[k] >= floor[k]) & (low[k] <= ceiling[k])
        rows = np.flatnonzero(wanted)
        if not len(rows):
            continue
        if k == 0:
            yield 0, rows, all_scores[rows]
            continue
        scores = _scores(block.vectors[rows], largest, tree.vectors[k], norms[k])
        low[k, rows] = high[k, rows] = scores
        yield k, rows, scores


def _merge(best: list[tuple[int, int]], block: Block, rows: np.ndarray, scores: np.ndarray, keep: int) -> list[tuple[int, int]]:
    """The first `keep` of (-score, id) from the list so far and the ids of some classes."""
    if len(rows) > keep:
        worst = np.partition(scores, len(scores) - keep)[len(scores) - keep]
        rows, scores = rows[scores >= worst], scores[scores >= worst]
        order = np.lexsort((block.ids[block.first[rows]], -scores))[:keep]
        rows, scores = rows[order], scores[order]
    found = [
        (-score, i)
        for row, score in zip(rows.tolist(), scores.tolist())
        for i in block.ids[block.first[row] : block.first[row + 1]].tolist()
    ]
    return sorted(best + found)[:keep]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            vectors, ids = _matrix(part.column(1)), part.column(2)
            first = ids.offsets.to_numpy()
            yield Block(part.column(0).to_numpy(), vectors, _norms(vectors), first - first[0], ids.flatten().to_numpy())


def _find_positives(trees: list[Tree], keep: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(label, code, ids) -> (class_id, score, vec_id): per anchor class the best rows of its label in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int]]] = {}
        floors = [np.full(len(t.edge), -np.inf) for t in trees]
        norms = [_norms(t.vectors) for t in trees]
        for block in _blocks(batches):
            for tree, floor, norm in zip(trees, floors, norms):
                for k, rows, scores in _walk(tree, norm, block, floor, np.full(len(floor), np.inf), same=True):
                    found = scores >= floor[k]
                    top = _merge(best.get(tree.class_ids[k], []), block, rows[found], scores[found], keep)
                    best[tree.class_ids[k]] = top
                    if len(top) == keep:
                        floor[k] = -top[-1][0]
        out = [(c, -s, i) for c, top in best.items() for s, i in top]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["class_id", "score", "vec_id"])

    return run


def _find_negatives(
    trees: list[Tree], positives: dict[int, list[int]], window: tuple[int, int], keep: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(label, code, ids) -> (class_id, positive_score, score, vec_id): the best rows of other labels in each window."""
    low_percent, high_percent = window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], list[tuple[int, int]]] = {}
        #: positive score -> lowest and highest score that can still enter its list
        windows = {
            c: {s: [-(-low_percent * s // 100), high_percent * s // 100] for s in scores} for c, scores in positives.items()
        }
        windows = {c: {s: w for s, w in found.items() if w[0] <= w[1]} for c, found in windows.items()}

        def hull(c: int) -> tuple[float, float]:
            return min((w[0] for w in windows[c].values()), default=np.inf), max((w[1] for w in windows[c].values()), default=-np.inf)

        hulls = [np.array([hull(c) for c in t.class_ids], dtype=np.float64).reshape(-1, 2) for t in trees]
        norms = [_norms(t.vectors) for t in trees]
        for block in _blocks(batches):
            for tree, bound, norm in zip(trees, hulls, norms):
                for k, rows, scores in _walk(tree, norm, block, bound[:, 0], bound[:, 1], same=False):
                    c = tree.class_ids[k]
                    for positive, limits in windows[c].items():
                        found = (scores >= limits[0]) & (scores <= limits[1])
                        if found.any():
                            top = _merge(best.get((c, positive), []), block, rows[found], scores[found], keep)
                            best[c, positive] = top
                            if len(top) == keep:
                                limits[0] = -top[-1][0]
                    bound[k] = hull(c)
        out = [(c, p, -s, i) for (c, p), top in best.items() for s, i in top]
        if out:
            names = ["class_id", "positive_score", "score", "vec_id"]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names)

    return run


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class_id, label, code) -> the same and a cell: the sides of random planes, so that near anchors come together."""
    for batch in batches:
        vectors = _matrix(batch.column(2)).astype(np.float64)
        planes = np.random.Generator(np.random.PCG64(17)).standard_normal((vectors.shape[1], _CELL_BITS))
        cell = ((vectors @ planes) > 0) @ (1 << np.arange(_CELL_BITS)[::-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64())], ["class_id", "label", "code", "cell"])


_TREE_SCHEMA = "class_ids array<long>, labels array<long>, vectors binary, parent array<long>, edge array<double>"


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class_id, label, code, cell), near ones next to each other -> one row per tree of TREE_ANCHORS of them."""
    held: list[pa.RecordBatch] = []
    schema = pa.schema([
        ("class_ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("vectors", pa.binary()),
        ("parent", pa.list_(pa.int64())), ("edge", pa.list_(pa.float64())),
    ])

    def tree(part: pa.Table) -> pa.RecordBatch:
        part = part.combine_chunks()
        t = spanning_tree(part.column(0).to_numpy(), part.column(1).to_numpy(), _matrix(part.column(2).chunk(0)))
        row = [t.class_ids, t.labels.tolist(), t.vectors.astype("<i8").tobytes(), t.parent.tolist(), t.edge.tolist()]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)

    for batch in batches:
        held.append(batch)
        while sum(b.num_rows for b in held) >= TREE_ANCHORS:
            table = pa.Table.from_batches(held)
            yield tree(table.slice(0, TREE_ANCHORS))
            held = table.slice(TREE_ANCHORS).to_batches()
    if sum(b.num_rows for b in held):
        yield tree(pa.Table.from_batches(held))


def _passes(trees: DataFrame) -> Iterator[list[Tree]]:
    """The trees in runs of at most PASS_BYTES, or of one tree."""
    held, size = [], 0
    for r in trees.toLocalIterator():
        vectors = np.frombuffer(r["vectors"], dtype="<i8").reshape(len(r["labels"]), -1)
        if held and size + vectors.nbytes > PASS_BYTES:
            yield held
            held, size = [], 0
        held.append(Tree(list(r["class_ids"]), np.array(r["labels"]), vectors, np.array(r["parent"]), np.array(r["edge"])))
        size += vectors.nbytes
    if held:
        yield held


def scaled(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, code): components times SCALE, rounded down; rows that can't take part are left out.

    These are rows with a null id, label or vector, or with a null, NaN or infinite component.
    """
    finite = F.forall(vector_col, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    limit = F.lit(float(MAX_COMPONENT))
    code = F.transform(
        vector_col, lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, limit), -limit)).cast("int")
    )
    taking_part = rows.where(
        F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite
    )
    return taking_part.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), code.alias("code"))


def _first(rows: DataFrame, keys: list[str], keep: int) -> DataFrame:
    """The first rows of each key by score, then id; Spark keeps so many per key before it shuffles."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)


def mine_hard_negatives(
    rows: DataFrame, is_anchor: str, n_positives: int = 5, n_negatives: int = 5, window: tuple[int, int] = (80, 100)
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from `scaled` rows.

    Anchors are the rows that meet the SQL condition `is_anchor`. The score of a row is its inner product with the
    anchor; higher scores come first, ties by smaller id. Positives are an anchor's first other rows of its label,
    negatives of a positive the first rows of other labels with low percent * positive score <= 100 * score <= high
    percent * positive score. All fewer are returned if there are no more; a negative positive score has no negatives.

    Equal vectors with equal labels are one class with its first ids, as many as any list can hold, so that copies are
    scored once. Anchor classes are laid into spanning trees of near neighbours. Passes over all rows take along a
    bounded number of trees: the first finds the positives, the second the negatives. Each row is scored at the root;
    from there, bounds go along the edges, and only rows that may enter an anchor's window are scored again. Tasks keep
    the best so far and return lists of fixed length. Where vectors lie in no clusters the bounds rule out little and
    the work is anchors times rows.

    Vectors of different lengths are compared as if filled up with zeros. Equal rows count once. Rows that share an id
    and differ are rows of their own; an anchor leaves out all rows of its own id. Other columns are ignored; without
    anchors, or on an empty table, the result is empty.
    """
    spark = rows.sparkSession
    keep = max(n_positives + 1, n_negatives)
    distinct = stage_table(rows.select("vec_id", "label", "code").distinct(), "vectors")
    in_class = Window.partitionBy("label", "code").orderBy("vec_id")
    classes = (
        distinct.withColumn("place", F.row_number().over(in_class))
        .where(F.col("place") <= keep)
        .groupBy("label", "code")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    classes = stage_table(classes.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    anchors = stage_table(
        distinct.where(is_anchor).join(classes.drop("ids"), ["label", "code"]).select(F.col("vec_id").alias("anchor_id"), "class_id"),
        "anchors",
    )
    anchor_classes = classes.join(anchors, "class_id", "left_semi").select("class_id", "label", "code")
    near = anchor_classes.mapInArrow(_cells, "class_id long, label long, code array<int>, cell long")
    near = near.repartitionByRange("cell", "class_id").sortWithinPartitions("cell", "class_id")
    trees = stage_table(near.mapInArrow(_trees, _TREE_SCHEMA), "trees")
    candidates = classes.select("label", "code", "ids")
    positive_path, negative_path = new_path(spark, "positives"), new_path(spark, "negatives")
    positive_schema = "class_id long, score long, vec_id long"
    negative_schema = "class_id long, positive_score long, score long, vec_id long"
    n_passes = 0
    for held in _passes(trees):
        found = candidates.mapInArrow(_find_positives(held, n_positives + 1), positive_schema)
        at = f"{positive_path}/pass={n_passes}"
        _first(found, ["class_id"], n_positives + 1).select("class_id", "score", "vec_id").write.parquet(at)
        scores: dict[int, list[int]] = {c: [] for tree in held for c in tree.class_ids}
        for r in spark.read.schema(positive_schema).parquet(at).select("class_id", "score").distinct().collect():
            scores[r["class_id"]].append(r["score"])
        found = candidates.mapInArrow(_find_negatives(held, scores, window, n_negatives), negative_schema)
        found = _first(found, ["class_id", "positive_score"], n_negatives)
        found.select("class_id", "positive_score", "score", "vec_id").write.parquet(f"{negative_path}/pass={n_passes}")
        n_passes += 1
    if not n_passes:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    positives = spark.read.schema(positive_schema).parquet(positive_path).select("class_id", "score", "vec_id")
    negatives = spark.read.schema(negative_schema).parquet(negative_path)
    lists = negatives.groupBy("class_id", "positive_score").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("negatives")
    )
    same = ["class_id", "score"]
    per_class = (
        positives.join(lists.withColumnRenamed("positive_score", "score"), same, "left")
        .groupBy("class_id")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id", "negatives"))).alias("positives"))
    )
    others = F.filter("positives", lambda p: p["vec_id"] != F.col("anchor_id"))
    pairs = anchors.join(per_class, "class_id").select("anchor_id", F.explode(F.slice(others, 1, n_positives)).alias("p"))
    return pairs.select("anchor_id", "p", F.posexplode("p.negatives").alias("place", "n")).select(
        "anchor_id",
        F.col("p.vec_id").alias("positive_id"),
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("n.vec_id").alias("negative_id"),
        (-F.col("p.minus")).alias("positive_score"),
        (-F.col("n.minus")).alias("negative_score"),
    )
