"""Packing of tokenized documents into sequences of one length with little padding."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.cutting_stock import plan_rolls
from tidemark.llm.words import find_runs, text_chunks, word_hashes
from tidemark.session import stage_table

MAX_LENGTH = 2048
END_ID = 1
#: Lengths are planned in steps of so many tokens, rounded up.
LENGTH_STEP = 4
#: Pieces of a length that are ranked together.
RANKED_TOGETHER = 100_000
_KNOWN_WORDS, _KNOWN_UNITS = 1_000_000, 400_000
#: Letters whose normal form, lower case and word borders do not depend on their neighbours; others go to the tokenizer.
_PLAIN = re.compile("[\t\n\r !-~¡-±´-¸º»¿-įĲ-ɏ]*")
#: Fixed value: the units of the tokenizer's own pattern, for plain lower-case texts.
_UNIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: The same for bytes: white space, and ASCII bytes that are not plain.
_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0D])
_ODD = (np.arange(256) < 0x20) & ~_SPACE | (np.arange(256) == 0x7F)
_HASHED_AT_ONCE = 200_000
_encoders: dict[str, _Encoder] = {}


class _Encoder:
    """Texts -> ids, with a table of known words that a Python worker keeps.

    The tokenizer drops white space and cuts the rest by a pattern into units (letters, a digit, marks) before anything
    else, so that equal units have equal ids wherever they stand. New units go to the tokenizer in one text; the last id
    of each unit is one of those that end a word. Words of a batch are looked up together, by 64-bit hashes in a sorted
    table; among as many words as the table takes, two share a hash with probability 3e-8. Texts with unusual letters or
    the tokenizer's special strings are given to it whole.
    """

    def __init__(self, model: str) -> None:
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(model)
        self.merger = Tokenizer.from_str(model)  # the same merges for units that are in lower case and cut already
        self.merger.normalizer = normalizers.Sequence([])
        self.merger.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_unit = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_unit[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.units: dict[str, bytes] = {}
        self.hashes = np.zeros(0, dtype=np.uint64)  # sorted; the word of hashes[i] has ids[first[i] : first[i] + count[i]]
        self.first = self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.array([END_ID], dtype="<u4")

    def whole(self, text: str) -> np.ndarray:
        """Ids of a text that is not plain, and the end id."""
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array([*ids, END_ID], dtype="<u4")

    def _learn(self, hashes: np.ndarray, new: list[str]) -> None:
        parts = [(w,) if w.isalpha() else _UNIT.findall(w) for w in new]
        unknown = list(set().union(*parts) - self.units.keys())
        for at in range(0, len(unknown), 2000):
            some = unknown[at : at + 2000]
            ids = np.array(self.merger.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = (4 * (np.flatnonzero(self.ends_unit[ids]) + 1)).tolist()
            if len(ends) != len(some):
                raise ValueError("the tokenizer does not mark the ends of its units")
            data = ids.tobytes()
            self.units.update(zip(some, [data[a:b] for a, b in zip([0, *ends], ends)]))
        found = [self.units[p[0]] if len(p) == 1 else b"".join([self.units[u] for u in p]) for p in parts]
        count = np.array([len(f) // 4 for f in found], dtype=np.int64)
        first = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), dtype="<u4")])
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.first, self.count = (
            np.insert(old, at, more) for old, more in ((self.hashes, hashes), (self.first, first), (self.count, count))
        )

    def plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of plain texts, each followed by the end id; number of ids of each text)."""
        words = find_runs(data, offsets, ~_SPACE[data])
        hashes = np.concatenate([
            word_hashes(words._replace(start=words.start[at : at + _HASHED_AT_ONCE], end=words.end[at : at + _HASHED_AT_ONCE]), lower=False)
            for at in range(0, max(1, len(words.start)), _HASHED_AT_ONCE)
        ])
        distinct, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > _KNOWN_WORDS:
            self._forget()
        if len(self.units) > _KNOWN_UNITS:
            self.units = {}
        place = np.searchsorted(self.hashes, distinct)
        known = place < len(self.hashes)
        known[known] = self.hashes[place[known]] == distinct[known]
        if not known.all():
            raw = data.tobytes()
            spans = zip(words.start[example[~known]].tolist(), words.end[example[~known]].tolist())
            self._learn(distinct[~known], [raw[a:b].decode().lower() for a, b in spans])
            place = np.searchsorted(self.hashes, distinct)
        texts = len(offsets) - 1
        ends = words.first[1:] + np.arange(texts)  # the end id counts as one more word of each text
        first, count = np.zeros(len(which) + texts, dtype=np.int64), np.ones(len(which) + texts, dtype=np.int64)
        is_word = np.ones(len(first), dtype=bool)
        is_word[ends] = False
        first[is_word], count[is_word] = self.first[place][which], self.count[place][which]
        until = np.cumsum(count)
        ids = self.ids[np.arange(until[-1]) + np.repeat(first - (until - count), count)]
        return ids, np.diff(until[ends], prepend=0)


def _encoder(model: str) -> _Encoder:
    if model not in _encoders:
        _encoders[model] = _Encoder(model)
    return _encoders[model]


def _not_plain(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Numbers of the texts that the tokenizer has to read itself."""
    special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
    suspect = np.concatenate([np.flatnonzero(_ODD[data]), special])
    odd = np.zeros(len(offsets) - 1, dtype=bool)
    odd[np.searchsorted(offsets, suspect, side="right") - 1] = True
    wide = np.zeros(len(offsets) - 1, dtype=bool)
    wide[np.searchsorted(offsets, np.flatnonzero(data >= 0x80), side="right") - 1] = True
    for i in np.flatnonzero(wide & ~odd).tolist():
        odd[i] = not _PLAIN.fullmatch(data[offsets[i] : offsets[i + 1]].tobytes().decode())
    return np.flatnonzero(odd)


def _pieces(model: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, text) -> its pieces; `model` is the tokenizer's file as a text, so that no worker has to find the file."""

    def cut(doc_ids: pa.Array, ids: np.ndarray, totals: np.ndarray) -> pa.RecordBatch:
        """Pieces of texts whose ids stand one after another."""
        pieces = -(-totals // MAX_LENGTH)
        row = np.repeat(np.arange(len(totals)), pieces)
        start = MAX_LENGTH * (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        length = np.minimum(MAX_LENGTH, totals[row] - start)
        low = 4 * ((np.cumsum(totals) - totals)[row] + start)
        data = memoryview(ids).cast("B")
        crc = [zlib.crc32(data[a:b]) for a, b in zip(low.tolist(), (low + 4 * length).tolist())]
        columns = [doc_ids.take(pa.array(row)), *[pa.array(c, pa.int64()) for c in (start, length, crc, totals[row])]]
        return pa.RecordBatch.from_arrays(columns, _PIECE_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for batch in batches:
            for first, last, data, offsets in text_chunks(batch.column(1)):
                doc_ids = batch.column(0).slice(first, last - first)
                odd = _not_plain(data, offsets)
                if len(odd):
                    for i in odd.tolist():
                        ids = encoder.whole(data[offsets[i] : offsets[i + 1]].tobytes().decode())
                        yield cut(doc_ids.slice(i, 1), ids, np.array([len(ids)]))
                    plain = np.setdiff1d(np.arange(last - first), odd)
                    keep = np.repeat(np.isin(np.arange(last - first), plain), np.diff(offsets))
                    offsets = np.concatenate([[0], np.cumsum(np.diff(offsets)[plain])])
                    data, doc_ids = data[keep], doc_ids.take(pa.array(plain))
                if len(doc_ids):
                    yield cut(doc_ids, *encoder.plain(data, offsets))

    return run


_PIECE_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
_PLAN_SCHEMA = "size int, per_roll long, rank_from long, rank_to long, roll_from long, first_slot long"


def _plan_rows(histogram: dict[int, int]) -> list[tuple]:
    """For each pattern and size: which ranks of the size go into which rolls."""
    rows, taken, rolls = [], dict.fromkeys(histogram, 0), 0
    for pattern, count in plan_rolls(histogram, MAX_LENGTH // LENGTH_STEP):
        slot = 0
        for size, per_roll in sorted(pattern.items(), reverse=True):
            rows.append((size, per_roll, taken[size], taken[size] + per_roll * count, rolls, slot))
            taken[size] += per_roll * count
            slot += per_roll
        rolls += count
    return rows


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) for each piece of each row.

    A document is its ids and one end id. It is cut at multiples of the sequence length, so that all pieces but the
    last fill a sequence. The histogram of the pieces' lengths, at most 512 numbers, is all that the driver sees: column
    generation turns it into patterns, and each piece finds its sequence by its rank among the pieces of its length.
    Ranks are counted in parts of a bounded number of pieces, so that a length that a third of all pieces have is no
    hot spot. `sequence_id` counts from 0 without gaps.

    Null and empty texts are one piece of one id. Repeated rows and null ids are packed like others. Extra columns are
    ignored; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = ", ".join(f"{name} long" for name in _PIECE_NAMES)
    model = Path(tokenizer_path).read_text(encoding="utf-8")
    pieces = stage_table(
        source.mapInArrow(_pieces(model), schema).withColumn(
            "size", F.ceil(F.col("length") / LENGTH_STEP).cast("int")
        ),
        "pieces",
    )
    histogram = {r["size"]: r["pieces"] for r in pieces.groupBy("size").agg(F.count(F.lit(1)).alias("pieces")).collect()}
    spark = docs.sparkSession
    plan = spark.createDataFrame(_plan_rows(histogram), _PLAN_SCHEMA)
    parts = spark.createDataFrame([(s, 1 + n // RANKED_TOGETHER) for s, n in histogram.items()], "size int, parts long")
    split = pieces.join(F.broadcast(parts), "size").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), "parts")
    )
    before = (
        split.groupBy("size", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("size").orderBy("part")) - F.col("n"))
        .drop("n")
    )
    in_part = Window.partitionBy("size", "part").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        split.withColumn("place", F.row_number().over(in_part).cast("long") - 1)
        .join(before, ["size", "part"])
        .withColumn("rank", F.col("before") + F.col("place"))
    )
    found = ranked.join(
        F.broadcast(plan.withColumnRenamed("size", "plan_size")),
        (F.col("size") == F.col("plan_size")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")),
    )
    shift = F.col("rank") - F.col("rank_from")
    placed = found.select(
        *_PIECE_NAMES,
        (F.col("roll_from") + F.floor(shift / F.col("per_roll"))).cast("long").alias("sequence_id"),
        (F.col("first_slot") + shift % F.col("per_roll")).alias("slot"),
    )
    up_to_here = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    return placed.select(
        *_PIECE_NAMES, "sequence_id", (F.sum("length").over(up_to_here) - F.col("length")).alias("offset")
    )
