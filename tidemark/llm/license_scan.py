"""License scan: base phrases, and an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import stage_table

#: Words of a block and the distance between blocks; any passage of up to BLOCK_STEP + 1 words lies in one block.
BLOCK_WORDS, BLOCK_STEP = 64, 32
#: Share of a template's distinct words that a block must hold.
MIN_CONTAINMENT = 0.9
# Base phrases and templates with their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
     "the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited proprietary and confidential"),
)
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _spaced(text: Column) -> Column:
    """The words in lower case, each between two spaces."""
    return F.concat(F.lit(" "), F.btrim(F.regexp_replace(F.lower(text), _NO_WORD, " ")), F.lit(" "))


def _spaces(c: Column) -> Column:
    return (F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))).cast("long")


def base_hits(docs: DataFrame) -> DataFrame:
    """Rows that have _spaced, with n_words, n_base, first_word, last_word and base (their labels, an array)."""
    spaced = F.col("_spaced")
    phrases = "|".join(PHRASES)
    found = F.lit(False)
    for phrase in PHRASES:
        found = found | spaced.contains(f" {phrase} ")
    pattern = f" (?:{phrases})(?= )"
    labels = F.array_distinct(F.array(*[F.when(spaced.contains(f" {p} "), F.lit(label)) for p, label in PHRASES.items()]))
    return (
        docs.withColumn("n_words", F.when(spaced == "  ", F.lit(0).cast("long")).otherwise(_spaces(spaced) - 1))
        .withColumn("n_base", F.when(found, F.regexp_count(spaced, F.lit(pattern)).cast("long")).otherwise(F.lit(0).cast("long")))
        .withColumn("first_word", F.when(found, _spaces(F.get(F.split(spaced, pattern, 2), 0))))
        .withColumn("last_word", F.when(found, _spaces(F.regexp_extract(spaced, f"(?s)^(.*) (?:{phrases})(?= )", 1))))
        .withColumn("base", F.array_compact(labels))
    )


def ordered_templates(counts: dict[str, int], templates=TEMPLATES) -> tuple[list[str], list[tuple]]:
    """(tokens from rare to frequent, rows (template, label, ranks, need)): the global order that the join works in.

    The order covers the templates' tokens only, as no other token can be shared; ties are broken by the token.
    """
    tokens = sorted({w for _, t in templates for w in t.split()}, key=lambda w: (counts.get(w, 0), w))
    rank = {w: r for r, w in enumerate(tokens, 1)}
    rows = []
    for number, (label, text) in enumerate(templates):
        ranks = sorted({rank[w] for w in text.split()})
        rows.append((number, label, ranks, math.ceil(MIN_CONTAINMENT * len(ranks) - 1e-9)))
    return tokens, rows


def passages(templates: Sequence[tuple[str, str]]) -> list[tuple[int, str, str, int]]:
    """(template, label, words, passages needed): templates in pieces of equal length, at most BLOCK_STEP + 1 words each.

    A passage of that length lies in one block, so a whole license text can be looked for as well as a sentence. Words
    are those of the scan. A template counts where MIN_CONTAINMENT of its passages are found; one without words never does.
    """
    out = []
    for number, (label, text) in enumerate(templates):
        words = re.sub(_NO_WORD, " ", text.lower()).split()
        pieces = math.ceil(len(words) / (BLOCK_STEP + 1))
        need = math.ceil(MIN_CONTAINMENT * pieces - 1e-9)
        cuts = [len(words) * k // pieces for k in range(pieces + 1)] if pieces else []
        out += [(number, label, " ".join(words[i:j]), need) for i, j in zip(cuts, cuts[1:])]
    return out


def _blocks(docs: DataFrame, tokens: list[str], prefix_ranks: list[int]) -> DataFrame:
    """(doc_id, text_hash, block, ranks): template tokens of every block that holds a token of some template's prefix.

    A text becomes one rank per word (0: no template token), and each block is a slice of that, so the work and the
    memory of a text grow with its length. The lambdas bind the ranks and the block numbers, which are made once.
    """
    names, prefix = F.array(*map(F.lit, tokens)), F.array(*map(F.lit, prefix_ranks))

    def block(ranks: Column, number: Column) -> Column:
        inside = F.filter(F.slice(ranks, number * BLOCK_STEP + 1, BLOCK_WORDS), lambda r: r > 0)
        return F.struct(number.alias("block"), F.sort_array(F.array_distinct(inside)).alias("ranks"))

    def blocks(ranks: Column) -> Column:
        last = F.array_distinct(
            F.array_compact(
                F.transform(ranks, lambda r, i: F.when(F.array_contains(prefix, r), F.floor(i / BLOCK_STEP).cast("int")))
            )
        )
        numbers = F.flatten(F.transform(F.array(last), lambda x: F.array_union(x, F.transform(x, lambda b: b - 1))))
        return F.transform(F.filter(numbers, lambda b: b >= 0), lambda b: block(ranks, b))

    ranks = F.transform(F.split(F.btrim("_spaced"), " "), lambda w: F.array_position(names, w).cast("int"))
    found = F.flatten(F.transform(F.array(ranks), blocks))
    return docs.select("doc_id", "text_hash", F.inline(found))


def _joined(blocks: DataFrame, templates: list[tuple]) -> DataFrame:
    """(doc_id, text_hash, block, passage, label, containment) of all block and template pairs that meet the threshold.

    A block that holds `need` of a template's n ranks holds one of its n - need + 1 rarest (prefix). At the first shared
    rank, what follows it on both sides must suffice (position), and so must the block's size (length). Survivors are
    verified. The prefix index has a few rows per template, whatever the corpus.
    """
    spark = blocks.sparkSession
    index = spark.createDataFrame(
        [
            (rank, number, place, len(ranks), need, label, ranks)
            for number, label, ranks, need in templates
            for place, rank in enumerate(ranks[: len(ranks) - need + 1])
        ],
        "rank int, passage int, place int, size int, need int, label string, template_ranks array<int>",
    )
    entries = blocks.select("*", F.posexplode("ranks").alias("at", "rank"))
    met = entries.join(F.broadcast(index), "rank")
    rest = 1 + F.least(F.col("size") - F.col("place") - 1, F.size("ranks") - F.col("at") - 1)
    passed = met.where((F.size("ranks") >= F.col("need")) & (rest >= F.col("need")))
    shared = F.size(F.array_intersect("ranks", "template_ranks"))
    return passed.where(shared >= F.col("need")).select(
        "doc_id", "text_hash", "block", "passage", "label", (shared / F.col("size")).alias("containment")
    )


def _whole_templates(met: DataFrame, pieces: list[tuple[int, str, str, int]]) -> DataFrame:
    """(doc_id, text_hash, more, containment): labels of the templates with enough passages, and the best containment."""
    of = [(k, number, need, sum(p[0] == number for p in pieces)) for k, (number, _, _, need) in enumerate(pieces)]
    owners = met.sparkSession.createDataFrame(of, "passage int, template int, least int, pieces int")
    best = met.groupBy("doc_id", "text_hash", "label", "passage").agg(F.max("containment").alias("containment"))
    held = best.join(F.broadcast(owners), "passage").groupBy("doc_id", "text_hash", "label", "template", "least", "pieces").agg(
        F.count(F.lit(1)).alias("found"), F.sum("containment").alias("held")
    )
    return held.where("found >= least").groupBy("doc_id", "text_hash").agg(
        F.collect_set("label").alias("more"), F.max(F.col("held") / F.col("pieces")).alias("containment")
    )


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    `templates` are (label, text), from a sentence to a whole license; their words go into the plan, so they are some
    hundred texts at most. `score` is 1 where a base phrase stands, else the best containment of a template that meets
    the threshold (the mean over its passages), else 0.
    Null and empty texts have no words and no labels; repeated rows get equal results; null ids are kept; extra columns
    are ignored; an empty table gives an empty result. Texts are read whole and never shuffled; the second pass looks
    only at texts with a token of some template's prefix.
    """
    spark: SparkSession = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), _spaced(text).alias("_spaced")
    )
    pieces = passages(templates)
    if not pieces:
        raise ValueError("no template has a word")
    vocabulary = sorted({w for _, _, words, _ in pieces for w in words.split()})
    known = F.array_intersect(F.split("_spaced", " "), F.array(*map(F.lit, vocabulary)))
    base = stage_table(base_hits(source).withColumn("known", known).drop("_spaced"), "licenses")
    counted = base.select(F.explode("known").alias("token")).groupBy("token").count().collect()
    tokens, ranked = ordered_templates({r["token"]: r["count"] for r in counted}, [p[1:3] for p in pieces])
    prefix = sorted({r for _, _, ranks, need in ranked for r in ranks[: len(ranks) - need + 1]})
    candidate = F.col("_spaced").rlike(f" (?:{'|'.join(tokens[r - 1] for r in prefix)}) ")
    met = _joined(_blocks(source.where(candidate), tokens, prefix), ranked)
    found = _whole_templates(met, pieces).withColumnsRenamed({"doc_id": "found_id", "text_hash": "found_hash"})
    joined = base.join(
        found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash")), "left"
    )
    more = F.coalesce("more", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", more)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
