"""Benchmark decontamination by templates: typed placeholders for numbers, names and units, hash-joined windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.words import Words, find_runs, span_hashes, text_chunks, window_hashes, word_hashes
from tidemark.session import stage_table

#: Tokens of a window; a shorter item is one window. A template with fewer plain words than half of that is widened.
WINDOW = 8
#: Plain words of a widened template, and of one that is the whole item as the item holds no more.
WIDE_PLAIN, MIN_ITEM_PLAIN = WINDOW // 2, 2
#: Share of an item's windows that a document must hold.
MIN_COVERAGE = 0.5
#: Places of the filter that spares windows without a partner the join; its size does not depend on any table.
FILTER_BITS = 1 << 23
#: Item windows may be broadcast if they and their slots are at most so many, about 40 MB; more are joined by shuffle.
BROADCAST_CELLS = 1_000_000
# Units of measure that may stand after a number.
UNITS = (
    "mm cm m km inch inches ft foot feet yard yards mile miles mg g kg gram grams lb lbs pound pounds ounce ounces ton "
    "tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days "
    "week weeks month months year years cent cents dollar dollars usd euro euros eur percent degree degrees mph kmh "
    "watt watts kw kwh volt volts"
).split()
PLAIN, NUMBER, NAME, UNIT, FIRST = range(5)
_CODES = np.array([0, 0x6E756D, 0x6E616D65, 0x756E6974, 0x66697273], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

_DIGIT, _LETTER, _STOP = (np.zeros(256, dtype=bool) for _ in range(3))
_DIGIT[0x30:0x3A] = True
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_STOP[[0x0A, 0x0D, 0x21, 0x2E, 0x3A, 0x3F]] = True
_INSIDE = _DIGIT | _LETTER


def _texts(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    chunk = next(text_chunks(pa.array(words)))
    return chunk[2], chunk[3]


def _unit_hashes() -> np.ndarray:
    data, offsets = _texts(UNITS)
    return np.sort(word_hashes(find_runs(data, offsets, _INSIDE[data])))


_UNIT_HASHES = _unit_hashes()


def find_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Words of letters and digits, and whether a sentence begins with them.

    A point or comma between two digits is part of the number; the quotes and dashes of U+2000 to U+203F are not
    letters.
    """
    inside = _INSIDE[data]
    if len(data) > 2:
        digit = _DIGIT[data]
        joins = ((data == 0x2E) | (data == 0x2C))[1:-1] & digit[:-2] & digit[2:]
        inside[1:-1] |= joins
        marks = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80))
        for k in range(3):
            inside[marks + k] = False
    words = find_runs(data, offsets, inside)
    stops = np.concatenate([[0], np.cumsum(_STOP[data] & ~inside)])
    first = np.ones(len(words.start), dtype=bool)
    first[1:] = stops[words.start[1:]] > stops[words.end[:-1]]
    begins = words.first[:-1]
    first[begins[begins < len(first)]] = True
    return words, first


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of one of each distinct key, number of its distinct key per key)."""
    _, at, number = np.unique(keys, return_index=True, return_inverse=True)
    return at, number


def folded_hashes(words: Words) -> np.ndarray:
    """A hash per word in lower case, by Unicode; words beyond ASCII are lowered once per distinct word."""
    hashes = word_hashes(words)
    beyond = np.concatenate([[0], np.cumsum(words.data >= 0x80)])
    places = np.flatnonzero(beyond[words.end] > beyond[words.start])
    if len(places):
        at, number = _distinct(hashes[places])
        spans = zip(words.start[places[at]].tolist(), words.end[places[at]].tolist())
        data, offsets = _texts([words.data[i:j].tobytes().decode("utf-8", "replace").lower() for i, j in spans])
        lowered = word_hashes(Words(data, np.arange(len(offsets)), offsets[:-1], offsets[1:]))
        hashes[places] = lowered[number]
    return hashes


def _capitals(words: Words) -> np.ndarray:
    """Whether words begin with a capital letter of any script."""
    data, start = words.data, words.start
    lead = data[start]
    capital = (lead >= 0x41) & (lead <= 0x5A)
    places = np.flatnonzero(lead >= 0xC0)
    if len(places):
        length = 2 + (lead[places] >= 0xE0) + (lead[places] >= 0xF0)
        code = np.zeros(len(places), dtype=np.uint32)
        for k in range(4):
            byte = data[np.minimum(start[places] + k, len(data) - 1)].astype(np.uint32)
            code = np.where(k < length, code << np.uint32(8) | byte, code)
        at, number = _distinct(code)
        letters = [int(c).to_bytes(4, "big").lstrip(b"\0").decode("utf-8", "replace") for c in code[at]]
        capital[places] = np.array([c.isupper() or c.istitle() for c in letters])[number]
    return capital


def classify(words: Words, first: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """PLAIN, NUMBER, NAME (capital inside a sentence), UNIT (after a number) or FIRST (capital that opens one)."""
    kinds = np.zeros(len(hashes), dtype=np.int8)
    if not len(hashes):
        return kinds
    lead = words.data[words.start]
    capital = _capitals(words)
    kinds[capital] = NAME
    kinds[capital & first] = FIRST
    kinds[_DIGIT[lead]] = NUMBER
    units = np.flatnonzero(kinds[:-1] == NUMBER) + 1
    units = units[~first[units]]
    at = np.minimum(np.searchsorted(_UNIT_HASHES, hashes[units]), len(_UNIT_HASHES) - 1)
    kinds[units[_UNIT_HASHES[at] == hashes[units]]] = UNIT
    return kinds


def _widen(start: np.ndarray, plain: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """End of each window that begins at `start` and is widened to the right, and start of the one widened to the left.

    Windows are widened until they hold WIDE_PLAIN plain words; -1 where the text has too few. `plain` counts the plain
    words before each token.
    """
    places = np.flatnonzero(np.diff(plain))
    last, first = plain[start] + WIDE_PLAIN - 1, plain[start + WINDOW] - WIDE_PLAIN
    if not len(places):
        return np.full(len(start), -1), np.full(len(start), -1)
    right, left = places[np.clip(last, 0, len(places) - 1)], places[np.clip(first, 0, len(places) - 1)]
    right = np.where((last < len(places)) & (owner[right] == owner[start]), right + 1, -1)
    return right, np.where((first >= 0) & (owner[left] == owner[start]), left, -1)


def _windows(
    data: np.ndarray, offsets: np.ndarray, widths: list[int], passes: np.ndarray | None
) -> Iterator[tuple[int, int, int, int, int, int, np.ndarray, np.ndarray]]:
    """(text, place, place it stands for, hash, width, kind of window, kinds of its tokens, their word hashes).

    Literal windows are of kind 0, templates of kind 1. A template with too few plain words is widened to the right, or
    to the left where the text ends; in an item with too few for both, the whole item stands for it. `passes` are the
    filter's places, for documents, which give both widened windows and all whole widths; None is for items.
    """
    words, first = find_tokens(data, offsets)
    hashes = folded_hashes(words)
    kinds = classify(words, first, hashes)
    codes = np.where(kinds == PLAIN, hashes, _CODES[kinds])
    plain = np.concatenate([[0], np.cumsum(kinds == PLAIN)])
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))
    begin = words.first[:-1][owner]

    def rows(kind: int, start: np.ndarray, end: np.ndarray, stands: np.ndarray, found: np.ndarray, width: int) -> Iterator[tuple]:
        if passes is not None:
            use = passes[(found & np.uint64(FILTER_BITS - 1)).astype(np.int64)]
            start, end, stands, found = start[use], end[use], stands[use], found[use]
        for i, j, at, h in zip(start.tolist(), end.tolist(), stands.tolist(), found.tolist()):
            yield int(owner[i]), int(i - begin[i]), int(at - begin[i]), h, width, kind, kinds[i:j], hashes[i:j]

    for width in widths:
        n = len(hashes) - width + 1
        if n <= 0:
            continue
        whole = owner[:n] == owner[width - 1 :]
        held = plain[width:] - plain[:-width]
        if width <= WINDOW:
            at = np.flatnonzero(whole)
            yield from rows(0, at, at + width, at, window_hashes(hashes, width)[at], width)
        template = 2 * held >= width
        if passes is not None or width < WINDOW:
            template |= held >= MIN_ITEM_PLAIN
        at = np.flatnonzero(whole & template & (held < width))
        found = window_hashes(codes, width)[at] if width <= WINDOW else span_hashes(codes, at, at + width)
        yield from rows(1, at, at + width, at, found, width)
        if width != WINDOW:
            continue
        at = np.flatnonzero(whole & (2 * held < width))
        right, left = _widen(at, plain, owner)
        use = right >= 0
        yield from rows(1, at[use], right[use], at[use], span_hashes(codes, at[use], right[use]), width)
        use = left >= 0 if passes is not None else (left >= 0) & ~use
        yield from rows(1, left[use], at[use] + width, at[use], span_hashes(codes, left[use], at[use] + width), width)
        if passes is None:
            at = at[(left < 0) & (right < 0)]
            start, end = begin[at], words.first[1:][owner[at]]
            use = plain[end] - plain[start] >= MIN_ITEM_PLAIN
            start, end, at = start[use], end[use], at[use]
            same = end - start == WINDOW
            found = np.where(same, window_hashes(codes, WINDOW)[np.minimum(start, n - 1)], span_hashes(codes, start, end))
            yield from rows(1, start, end, at, found, width)


_SCHEMA = "id long, place long, stands long, hash long, width int, kind int, slots array<struct<type:int,value:long>>"


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _window_rows(widths: list[int], packed: bytes | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Windows of (id, text) rows. Slots are the numbers, names and units of a template window, by their hashes."""
    slot_type = pa.list_(pa.struct([("type", pa.int32()), ("value", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = None if packed is None else np.unpackbits(np.frombuffer(packed, dtype=np.uint8)).astype(bool)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, _, data, offsets in text_chunks(batch.column(1)):
                rows: list[tuple] = []
                for text, place, stands, found, width, kind, kinds, values in _windows(data, offsets, widths, passes):
                    slots = [
                        {"type": int(k), "value": _signed(int(v))}
                        for k, v in zip(kinds, values)
                        if k not in (PLAIN, FIRST)
                    ]
                    rows.append((ids[at + text], place, stands, _signed(found), width, kind, slots if kind else []))
                if rows:
                    c = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()),
                         pa.array(c[3], pa.int64()), pa.array(c[4], pa.int32()), pa.array(c[5], pa.int32()),
                         pa.array(c[6], slot_type)],
                        ["id", "place", "stands", "hash", "width", "kind", "slots"],
                    )

    return run


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of each item, and whether its plain words are so few that the whole item may stand for a window."""
    for batch in batches:
        for at, stop, data, offsets in text_chunks(batch.column(1)):
            words, first = find_tokens(data, offsets)
            plain = np.concatenate([[0], np.cumsum(classify(words, first, folded_hashes(words)) == PLAIN)])
            held = plain[words.first[1:]] - plain[words.first[:-1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, stop - at), pa.array(np.diff(words.first), pa.int64()), pa.array(held < 2 * WIDE_PLAIN)],
                ["item_id", "tokens", "sparse"],
            )


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, coverage, matched_windows, item_windows, changed) of documents that hold a benchmark item.

    Both sides become tokens; a literal window is WINDOW words in lower case (of any script), a template window has placeholders for
    numbers, names, units and for a capitalised word that opens a sentence; one with few plain words is widened until it
    holds WIDE_PLAIN of them, or to the whole item, and stands for its place. Windows meet by a join on their hash. Literal
    windows always count. Template windows count where, per alignment of a document and an item, each number, name and
    unit of the item stands for one value of the document all along. A pair is a leak if the windows that count cover
    MIN_COVERAGE of the item's windows. `changed` is true if a slot of a counted alignment has another value than in
    the item.

    Null and empty texts and items hold no window and never match. Repeated rows and items count once; ids that are
    null are left out, as they name nothing. Extra columns are ignored; an empty table on either side gives an empty
    result.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null")
    items = items.distinct()
    counts = stage_table(items.mapInArrow(_token_counts, "item_id long, tokens long, sparse boolean").where("tokens > 0"), "items")
    widths = [r[0] for r in counts.select(F.least("tokens", F.lit(WINDOW)).cast("int")).distinct().collect()]
    sparse = counts.where(F.col("sparse") & (F.col("tokens") > WINDOW))
    wide = [r[0] for r in sparse.select(F.col("tokens").cast("int")).distinct().collect()]
    item_windows = stage_table(
        items.mapInArrow(_window_rows(sorted(widths), None), _SCHEMA)
        .withColumnsRenamed({"id": "item_id", "place": "item_start", "stands": "item_place", "slots": "item_slots"})
        .join(counts, "item_id")
        .where(F.col("width") == F.least("tokens", F.lit(WINDOW)))
        .withColumn("item_windows", F.greatest(F.col("tokens") - WINDOW + 1, F.lit(1)))
        .drop("tokens", "sparse", "width")
        .dropDuplicates(["item_id", "item_place", "hash"]),
        "item-windows",
    )
    places = item_windows.select(F.col("hash").bitwiseAND(FILTER_BITS - 1).cast("int").alias("bit")).distinct()
    passes = np.zeros(FILTER_BITS, dtype=bool)
    passes[places.toArrow().column(0).to_numpy()] = True
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    doc_windows = (
        source.where("doc_id is not null")
        .mapInArrow(_window_rows(sorted(widths) + sorted(wide), np.packbits(passes).tobytes()), _SCHEMA)
        .withColumnsRenamed({"id": "doc_id"})
        .drop("stands")
    )
    cells = item_windows.agg(F.sum(1 + F.size("item_slots"))).first()[0]
    if (cells or 0) <= BROADCAST_CELLS:
        item_windows = F.broadcast(item_windows)
    met = doc_windows.join(item_windows, ["hash", "kind"]).withColumn("shift", F.col("place") - F.col("item_start"))
    met = met.withColumn(
        "pairs",
        F.transform(
            F.arrays_zip("slots", "item_slots"),
            lambda x: F.struct(
                x["item_slots"]["value"].alias("item"), x["slots"]["value"].alias("doc"), x["item_slots"]["type"].alias("type")
            ),
        ),
    )
    aligned = met.groupBy("doc_id", "item_id", "shift").agg(
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
        F.collect_set("item_place").alias("all_places"),
        F.collect_set(F.when(F.col("kind") == 0, F.col("item_place"))).alias("literal_places"),
        F.max("item_windows").alias("item_windows"),
    )
    slots = F.array_distinct(F.transform("pairs", lambda x: F.struct(x["type"], x["item"])))
    consistent = F.size(slots) == F.size("pairs")
    counted = aligned.withColumn("places", F.when(consistent, F.col("all_places")).otherwise(F.col("literal_places")))
    leaks = counted.where(F.size("places") > 0).groupBy("doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("matched_windows"),
        F.max("item_windows").alias("item_windows"),
        F.max(F.exists("pairs", lambda x: x["item"] != x["doc"])).alias("changed"),
    )
    return leaks.withColumn("coverage", F.col("matched_windows") / F.col("item_windows")).where(
        F.col("coverage") >= MIN_COVERAGE
    ).select("doc_id", "item_id", "coverage", "matched_windows", "item_windows", "changed")
