"""Trie of conversation prefixes from vertical bitmaps: (position, turn) -> bitset of conversations."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import stage_table

#: Bits of a conversation's number inside its shard: a bitset has 2 ** SHARD_BITS places.
SHARD_BITS = 10
#: Positions that one task walks through; longer conversations are walked in segments.
SEGMENT = 256
_PART_BITS = 33  # of monotonically_increasing_id, for the place in the partition
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _part(number: str) -> F.Column:
    return F.shiftright(number, _PART_BITS)


def number_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, position, turn_1, turn_2, n_bytes): the place of each turn in its conversation, from 0, staged.

    `turns` has conv_id, turn, role and text. Turns are ordered by turn (null first), then role, then text; a null role
    or text is empty. Rows without conv_id are left out; repeated rows are turns of their own. A turn becomes two
    64-bit hashes of its role and text and the length of its text in bytes; texts go no further.

    Rows are sorted in ranges, so that a conversation with many of all rows is numbered by many tasks: the place inside
    a range plus the rows in the ranges before.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"),
        F.monotonically_increasing_id().alias("spread"),  # lets even equal rows be dealt to several ranges
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text", "spread"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id",
        F.xxhash64("role", "text").alias("turn_1"),
        F.xxhash64(F.lit("turn"), "text", "role").alias("turn_2"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("number"),
    )
    ranged = stage_table(ranged, "turns").withColumn("part", _part("number"))
    starts = ranged.groupBy("conv_id", "part").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    placed = ranged.join(starts, ["conv_id", "part"]).select(
        "conv_id", (F.col("before") + F.col("number") - F.col("first")).alias("position"), "turn_1", "turn_2", "n_bytes"
    )
    return stage_table(placed, "placed")


def splice(numbered: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with the start of another one: (turns like `numbered`, all conversation ids).

    Conversation c starts with the first h turns of conversation c - c % group (all if it has fewer, none if it has
    none) and goes on with its own turns after its first h; h is the CRC-32 of c in decimals modulo `heads`.
    """
    sizes = numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    sizes = sizes.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    starts = (
        numbered.where(F.col("position") < heads - 1)
        .where(F.col("conv_id") % group == 0)
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("position", "turn_1", "turn_2", "n_bytes"))).alias("start"))
    )
    plan = sizes.join(starts.withColumnRenamed("conv_id", "base"), "base", "left").withColumn(
        "start", F.slice(F.coalesce("start", F.array().cast(starts.schema["start"].dataType)), 1, F.col("h").cast("int"))
    )
    plan = stage_table(plan.withColumn("taken", F.size("start").cast("long")), "splices")
    copied = plan.select("conv_id", F.explode("start").alias("t")).select("conv_id", "t.*")
    own = numbered.join(plan.where("n > h").select("conv_id", "h", "taken"), "conv_id").where("position >= h")
    own = own.select("conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), "turn_1", "turn_2", "n_bytes")
    return copied.unionByName(own), plan.select("conv_id")


_NODE_SCHEMA = (
    "key_1 long, key_2 long, up_1 long, up_2 long, depth long, conv_id long, n_convs long, n_bytes long, "
    "longer boolean, shard long, ends string"
)


def _grow(table: pa.Table) -> pa.Table:
    """Nodes of one shard and segment, by depth-first intersection of bitsets.

    A row is a turn: the number of its conversation (bit), its position, what identifies it (x_1, x_2) and the key of
    the conversation's prefix before the segment. A node's key is the exclusive or of its turns' x.
    """
    columns = table.to_pydict()
    shard = columns["shard"][0]
    conv_of, starts = {}, defaultdict(int)
    postings: dict[tuple[int, int, int], int] = defaultdict(int)
    turn_at: dict[int, dict[int, tuple[int, int, int]]] = defaultdict(dict)
    present: dict[int, int] = defaultdict(int)
    ending: dict[int, int] = defaultdict(int)
    first = min(columns["position"])
    for bit, conv, position, length, x_1, x_2, n_bytes, p_1, p_2 in zip(
        *[columns[c] for c in ("bit", "conv_id", "position", "length", "x_1", "x_2", "n_bytes", "p_1", "p_2")]
    ):
        mask = 1 << bit
        conv_of[bit] = conv
        postings[position, x_1, x_2] |= mask
        turn_at[position][bit] = (x_1, x_2, n_bytes)
        present[position] |= mask
        if length == position + 1:
            ending[position] |= mask
        if position == first:
            starts[p_1, p_2] |= mask
    nodes: list[tuple] = []

    def ids(bits: int) -> str | None:
        found = []
        while bits:
            low = bits & -bits
            found.append(str(conv_of[low.bit_length() - 1]))
            bits ^= low
        return ",".join(found) or None

    stack = [(first, bits, p_1, p_2) for (p_1, p_2), bits in starts.items()]
    while stack:
        position, members, up_1, up_2 = stack.pop()
        members &= present[position]
        while members:
            least = (members & -members).bit_length() - 1
            x_1, x_2, n_bytes = turn_at[position][least]
            child = members & postings[position, x_1, x_2]
            members ^= child
            key_1, key_2 = up_1 ^ x_1, up_2 ^ x_2
            ends = child & ending[position]
            nodes.append((
                key_1, key_2, up_1, up_2, position + 1, conv_of[least], child.bit_count(), n_bytes, child != ends, shard,
                ids(ends),
            ))
            if child != ends and position + 1 in present:
                stack.append((position + 1, child, key_1, key_2))
    return pa.table(list(zip(*nodes)), schema=_arrow_schema())  # there is a row, hence a node


def _arrow_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in _NODE_SCHEMA.split(", ")])


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key_1, key_2, ends), sorted by key and shard -> (key_1, key_2, ends_sha256); one part of a list at a time."""
    key, digest = None, None
    names = ["key_1", "key_2", "ends_sha256"]
    for batch in batches:
        done = []
        for k_1, k_2, ends in zip(*[c.to_pylist() for c in batch.columns]):
            if (k_1, k_2) == key:
                digest.update(f",{ends}".encode())
                continue
            if key:
                done.append((*key, digest.hexdigest()))
            key, digest = (k_1, k_2), hashlib.sha256(ends.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names)
    if key:
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, digest.hexdigest())], names)


_KEY, _UP = ["key_1", "key_2"], ["up_1", "up_2"]


def _subtree_sums(shared: DataFrame) -> DataFrame:
    """(key, n_leaves, saved_tokens): sums of `leaves` and `saved` over each node's subtree among `shared` nodes.

    By doubling: after round k a node has the sum of its descendants less than 2 ** k below it, and knows its ancestor
    2 ** k above. A round adds to that ancestor what the node has; rounds end when no node lies so deep.
    """
    now = stage_table(shared.select(*_KEY, "depth", *_UP, "leaves", "saved"), "sums")
    reach, deepest = 1, now.agg(F.max("depth")).first()[0]
    while deepest is not None and deepest >= reach:
        deep = now.where(F.col("depth") >= reach)
        added = deep.groupBy(*_UP).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        added = added.withColumnsRenamed({"up_1": "key_1", "up_2": "key_2"})
        above = now.where(F.col("depth") >= reach).select(
            *[F.col(k).alias(u) for k, u in zip(_KEY, _UP)], *[F.col(u).alias(f"next_{u}") for u in _UP]
        )
        up = now.where(F.col("depth") >= 2 * reach).select(*_KEY, *_UP).join(above, _UP).drop(*_UP)
        now = stage_table(
            now.drop(*_UP).join(added, _KEY, "left").join(up, _KEY, "left").select(
                *_KEY, "depth", *[F.col(f"next_{u}").alias(u) for u in _UP],
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "sums",
        )
        reach *= 2
    return now.select(*_KEY, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per distinct prefix.

    `turns` has (conv_id, position, turn_1, turn_2, n_bytes), as `number_turns` gives it, `convs` all conversation ids,
    turnless ones included. A node of depth d is a distinct sequence of the first d turns; the root has depth 0.
    `conv_id` is the least member, `parent_conv_id` that of the parent (root: null); n_convs, n_children and n_leaves
    count members, children, and childless nodes of the subtree, the node itself included; saved_tokens sums
    (n_convs - 1) * bytes of the last text over the subtree; ends_sha256 is the SHA-256 of the ids, ascending and
    comma-joined, of the members that end there. Without conversations there is no node.

    Conversations are numbered in ascending order and cut into shards of 2 ** SHARD_BITS. A task indexes a shard's turns
    by position as bitsets and walks from each prefix to its children by intersections; population counts, least ids and
    end lists leave the task. A first turn or a conversation that a third of all have is one bitset per shard, and the
    shards' counts are added up before they meet. Conversations of more than SEGMENT turns are walked in segments, each
    from the prefixes' keys at its start. End lists come in order of the shards and are hashed one after another, in
    one task per list and a part at a time, for a hash has no parallel form.
    """
    order = convs.select("conv_id").distinct().repartitionByRange("conv_id").sortWithinPartitions("conv_id")
    numbers = stage_table(order.select("conv_id", F.monotonically_increasing_id().alias("number")), "numbers")
    hashed = turns.select(
        "conv_id", "position", "n_bytes",
        F.xxhash64("position", "turn_1", "turn_2").alias("x_1"), F.xxhash64("turn_2", "turn_1", "position").alias("x_2"),
        F.floor(F.col("position") / SEGMENT).alias("segment"),
    )
    hashed = stage_table(hashed, "positions")
    pieces = hashed.groupBy("conv_id", "segment").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("x_1").alias("x_1"), F.bit_xor("x_2").alias("x_2")
    )
    whole = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "conv_id", "segment",
        F.coalesce(F.bit_xor("x_1").over(whole), F.lit(0)).alias("p_1"),
        F.coalesce(F.bit_xor("x_2").over(whole), F.lit(0)).alias("p_2"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("length"),
    ).join(numbers, "conv_id")
    rows = hashed.join(pieces, ["conv_id", "segment"]).select(
        F.shiftright("number", SHARD_BITS).alias("shard"), "segment",
        F.col("number").bitwiseAND((1 << SHARD_BITS) - 1).alias("bit"),
        "conv_id", "position", "length", "x_1", "x_2", "n_bytes", "p_1", "p_2",
    )
    partial = stage_table(rows.groupBy("shard", "segment").applyInArrow(_grow, _NODE_SCHEMA), "partial")
    merged = partial.groupBy(*_KEY).agg(
        *[F.first(c).alias(c) for c in (*_UP, "depth", "n_bytes")],
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.max("longer").alias("longer"),
    )
    ending = numbers.join(turns.select("conv_id").distinct(), "conv_id", "left_anti")
    at_root = ending.groupBy(F.shiftright("number", SHARD_BITS).alias("shard")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ends")
    )
    none = F.lit(None).cast("long")
    root = (
        numbers.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
        .where("n_convs > 0")
        .select(
            *[F.lit(0).cast("long").alias(k) for k in _KEY], *[none.alias(u) for u in _UP], F.lit(0).cast("long").alias("depth"),
            F.lit(0).cast("long").alias("n_bytes"), "conv_id", "n_convs", F.lit(True).alias("longer"),
        )
    )
    nodes = stage_table(merged.unionByName(root), "nodes")
    kids = nodes.where("depth > 0").groupBy(*_UP).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("single")
    )
    kids = kids.withColumnsRenamed({"up_1": "key_1", "up_2": "key_2"})
    # below a node of one conversation there is one path: one leaf, nothing saved; such nodes stay out of the sums
    shared = nodes.where("n_convs > 1 or depth = 0").join(kids, _KEY, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)),
        "leaves": F.coalesce("single", F.lit(0)) + F.coalesce("n_children", F.lit(0)).eqNullSafe(0).cast("long"),
        "saved": (F.col("n_convs") - 1) * F.col("n_bytes"),
    })
    shared = stage_table(shared, "shared")
    sums = shared.select(*_KEY, "n_children").join(_subtree_sums(shared), _KEY)
    parents = shared.select(
        F.col("key_1").alias("up_1"), F.col("key_2").alias("up_2"), F.col("conv_id").alias("shared_parent")
    )
    zero = F.lit(0).cast("long")
    ends = partial.where("ends is not null").select(*_KEY, "shard", "ends").unionByName(
        at_root.select(zero.alias("key_1"), zero.alias("key_2"), "shard", "ends")
    )
    ends = ends.repartition(*_KEY).sortWithinPartitions(*_KEY, "shard").select(*_KEY, "ends")
    hashes = ends.mapInArrow(_hash_ends, "key_1 long, key_2 long, ends_sha256 string")
    return (
        nodes.join(parents, _UP, "left")
        .join(sums, _KEY, "left")
        .join(hashes, _KEY, "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("depth") > 0, F.coalesce("shared_parent", "conv_id")).alias("parent_conv_id"),
            "n_convs",
            F.coalesce("n_children", F.col("longer").cast("long")).alias("n_children"),
            F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
            F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
