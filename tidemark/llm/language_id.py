"""Language identification with hyperdimensional profiles: bound letters, bundled n-grams, cosine with prototypes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.words import mix

DIMENSIONS = 1024
#: Letters that are bound to one vector; what stands between words counts as one letter.
GRAM = 3
UNKNOWN = "und"
#: Characters and texts that are counted together; a longer text is read in slices and counted whole.
CHARS_AT_ONCE, TEXTS_AT_ONCE = 1_000_000, 256
_GRAMS_AT_ONCE = 8192
#: Languages that may be learned; their prototypes, 8 KB each, are gathered by the driver. More raise an error.
MAX_LANGUAGES = 2000
#: Up to so many different letters, n-grams are numbered directly and not sorted.
_SMALL_ALPHABET = 200
_BREAK = 0
_SEED = np.uint64(0x5DEECE66D1CE4E5B)


class Grams(NamedTuple):
    """The n-grams of some texts: one `gram[i]`, which is the letters `letters[gram[i]]`, in text `row[i]`."""

    row: np.ndarray
    gram: np.ndarray
    letters: np.ndarray


class Profiles(NamedTuple):
    """Languages in alphabetical order and their prototypes, vectors of length 1."""

    languages: list[str]
    prototypes: np.ndarray


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def letter_vectors(letters: np.ndarray) -> np.ndarray:
    """A random vector of +1 and -1 per code point, which follows from the code point alone."""
    blocks = np.arange(DIMENSIONS // 64, dtype=np.uint64)
    bits = mix(mix(letters.astype(np.uint64) + _SEED)[:, None] + blocks[None, :])
    return (2 * np.unpackbits(bits.astype("<u8").view(np.uint8), axis=1).astype(np.int8) - 1).reshape(len(letters), -1)


def gram_vectors(letters: np.ndarray) -> np.ndarray:
    """Vector of each n-gram: the product of its letters' vectors, each permuted (rolled) by its place."""
    alphabet, where = np.unique(letters, return_inverse=True)
    vectors, where = letter_vectors(alphabet), where.reshape(letters.shape)
    out = vectors[where[:, GRAM - 1]]
    for place in range(GRAM - 1):
        out *= np.roll(vectors, GRAM - 1 - place, axis=1)[where[:, place]]
    return out


def _slices(texts: Sequence[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts in runs of bounded size: (row of each, lower-case text with a break around it).

    Slices of one long text overlap by what an n-gram reaches over, so that each of its n-grams is met once.
    """
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        if not text:
            continue
        text = f" {text.lower()} "
        at = 0
        while True:
            part = text[at : at + CHARS_AT_ONCE]
            rows.append(row)
            parts.append(part)
            size += len(part)
            if size >= CHARS_AT_ONCE:
                yield rows, parts
                rows, parts, size = [], [], 0
            at += CHARS_AT_ONCE
            if at >= len(text):
                break
    if rows:
        yield rows, parts


def _symbols(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code point of each letter, with one break for all that stands between two words; number of its part)."""
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    part = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    letter = _is_letter()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[np.searchsorted(part, np.arange(len(parts)))] = True
    return np.where(letter, codes, _BREAK)[keep].astype(np.int64), part[keep]


def count_grams(texts: Sequence[str | None]) -> Iterator[Grams]:
    """All n-grams of whole texts, in runs of bounded size; a text may be in more than one run."""
    tail: tuple[int, np.ndarray] = (-1, np.zeros(0, dtype=np.int64))
    for rows, parts in _slices(texts):
        symbols, part = _symbols(parts)
        row = np.array(rows)[part]
        if tail[0] == rows[0]:  # the text goes on: its last letters belong to the first n-grams here
            if len(tail[1]) and tail[1][-1] == _BREAK and symbols[0] == _BREAK:
                symbols, row = symbols[1:], row[1:]
            symbols, row = np.concatenate([tail[1], symbols]), np.concatenate([np.full(len(tail[1]), rows[0]), row])
        tail = rows[-1], symbols[row == rows[-1]][1 - GRAM :]
        inside = row[: 1 - GRAM] == row[GRAM - 1 :] if len(row) >= GRAM else np.zeros(0, dtype=bool)
        if not inside.any():
            continue
        alphabet = np.flatnonzero(np.bincount(symbols))
        number = np.zeros(alphabet[-1] + 1, dtype=np.int64)
        number[alphabet] = np.arange(len(alphabet))
        number = number[symbols]
        code = np.zeros(len(inside), dtype=np.int64)
        for place in range(GRAM):
            code = code * len(alphabet) + number[place : place + len(inside)]
        code, row = code[inside], row[: len(inside)][inside]
        if len(alphabet) <= _SMALL_ALPHABET:
            there = np.bincount(code, minlength=len(alphabet) ** GRAM) > 0
            distinct, gram = np.flatnonzero(there), (np.cumsum(there) - 1)[code]
        else:
            distinct, gram = np.unique(code, return_inverse=True)
        places = [distinct // len(alphabet) ** (GRAM - 1 - p) % len(alphabet) for p in range(GRAM)]
        yield Grams(row, gram, alphabet[np.stack(places, axis=1)])


def bundle(grams: Grams, rows: int) -> np.ndarray:
    """Sum of the n-gram vectors of each text: whole numbers below 2**24, which are exact."""
    out = np.zeros((rows, DIMENSIONS), dtype=np.float32)
    row, gram = grams.row, grams.gram
    if len(grams.letters) > _GRAMS_AT_ONCE:
        order = np.argsort(gram, kind="stable")
        row, gram = row[order], gram[order]
    for low in range(0, len(grams.letters), _GRAMS_AT_ONCE):
        letters = grams.letters[low : low + _GRAMS_AT_ONCE]
        a, b = (0, len(gram)) if len(letters) == len(grams.letters) else np.searchsorted(gram, [low, low + len(letters)])
        table = np.bincount(row[a:b] * len(letters) + (gram[a:b] - low), minlength=rows * len(letters))
        out += table.reshape(rows, -1).astype(np.float32) @ gram_vectors(letters).astype(np.float32)
    return out


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> (lang, sum of the n-gram vectors of all its texts in this task)."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        present = sorted(set(langs))
        number = np.array([present.index(x) for x in langs], dtype=np.int64)
        for grams in count_grams(batch.column(1).to_pylist()):
            found = bundle(grams._replace(row=number[grams.row]), len(present)).astype(np.float64)
            for k in np.unique(number[grams.row]):
                sums[present[k]] = sums.get(present[k], 0) + found[k]
        if len(sums) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
    for lang, vector in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([vector.astype(np.int64)], pa.list_(pa.int64()))], ["lang", "bundle"]
        )


def learn_profiles(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Prototype of every language: the sum of all n-grams of all its texts, scaled to length 1.

    Tasks bundle what they read, so that a language that most texts have is no hot spot; only the sums, one vector
    per task and language, are shuffled. Sums are whole numbers and do not depend on the order of the texts. Rows
    without language or text, and texts without a letter, teach nothing; without any other there is no language.
    """
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null")
    bundles = rows.mapInArrow(_bundles, "lang string, bundle array<long>")
    sums = (
        bundles.select("lang", F.posexplode("bundle").alias("place", "value"))
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("place", "value")))["value"].alias("bundle"))
    )
    found = sorted(sums.limit(MAX_LANGUAGES + 1).collect())
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    vectors = np.array([r["bundle"] for r in found], dtype=np.float64).reshape(len(found), DIMENSIONS)
    lengths = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    return Profiles([r["lang"] for r in found], vectors / np.maximum(lengths, 1))


def similarities(texts: Sequence[str | None], profiles: Profiles) -> tuple[np.ndarray, np.ndarray]:
    """(cosine of each text with each prototype, whether the text has a letter)."""
    sums = np.zeros((len(texts), DIMENSIONS))
    lettered = np.zeros(len(texts), dtype=bool)
    for grams in count_grams(texts):
        sums += bundle(grams, len(texts))
        lettered[grams.row] = True
    lengths = np.sqrt((sums**2).sum(axis=1, keepdims=True))
    return (sums / np.maximum(lengths, 1)) @ profiles.prototypes.T, lettered


def _predictions(profiles: Profiles) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(text, ...) -> (lang_pred, score, ...)."""
    names = np.array([*profiles.languages, UNKNOWN], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                cosines, known = similarities(part.column(0).to_pylist(), profiles)
                known &= len(profiles.languages) > 0
                best = cosines.argmax(axis=1) if len(profiles.languages) else np.zeros(len(known), dtype=np.int64)
                top = cosines.max(axis=1, initial=0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[np.where(known, best, -1)], pa.string()),
                        pa.array(np.where(known, np.clip(top, 0, 1), 0.0)),
                        *part.columns[1:],
                    ],
                    ["lang_pred", "score", *part.schema.names[1:]],
                )

    return run


def identify(docs: DataFrame, profiles: Profiles, carry: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """(columns in `carry`, lang_pred, score) of every row: the language whose prototype has the greatest cosine.

    Whole texts are read: letters in lower case, everything between two words as one break, one vector per three of
    them in a row. `score` is the cosine, 0 where it is negative. Of equal cosines the first language in alphabetical
    order wins. Null texts, texts without a letter and, without any learned language, all texts are `und` with score 0.
    Repeated rows give repeated rows; other columns are ignored; an empty table gives an empty result.
    """
    kept = [docs.schema[name] for name in carry]
    schema = ", ".join(["lang_pred string", "score double", *[f"`_carry{i}` {f.dataType.simpleString()}" for i, f in enumerate(kept)]])
    rows = docs.select(F.col(text_col).alias("text"), *[F.col(f"`{f.name}`").alias(f"_carry{i}") for i, f in enumerate(kept)])
    found = rows.mapInArrow(_predictions(profiles), schema)
    return found.select(*[F.col(f"_carry{i}").alias(f.name) for i, f in enumerate(kept)], "lang_pred", "score")


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept out of learning: a third of all, by the CRC-32 of the id in decimals; without id it is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
