"""Secret scan: fixed patterns, and character Markov models of random strings against ordinary identifiers."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Patterns of the three base kinds, in the order in which ties are listed.
ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
MIN_ASSIGNED = 12
#: What the models judge: runs of so many characters that hold a digit and a letter.
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
#: Takes the place of each character of a base span while the models look at what is left; pieces of runs beside it may
#: be as short as a part.
BLANK = "\x01"
_BESIDE_BLANK = "(?<=\x01)[A-Za-z0-9+/_=-]{16,}|[A-Za-z0-9+/_=-]{16,}+(?=\x01)"
#: The characters of the two base kinds that consist of one class, one by one: the first of a match, or one behind it.
_ACCESS_CHARS = "(?:(?=AKIA[A-Z0-9]{14})|(?!\\A)\\G)[A-Z0-9]"
_HEX_CHARS = "(?:(?=[0-9a-f]{16})|(?!\\A)\\G)[0-9a-f]"
#: Values that are added up together, so that the work for a list grows with its length.
_BLOCK = 512
#: Characters of a text that are rebuilt together.
_CHUNK = 1024
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
KINDS = ("assign", "access", "hex", "markov")
#: Mean log-likelihood ratio per character pair from which a run counts as random.
MIN_RATIO = 1.0
#: Inside a run that is not random as a whole, a segment counts if its ratios add up to so much, or if its part between
#: `=`, `/`, `_` and `-` counts as random alone and has this share of letters (times and dates have fewer).
PART_SUM, PART_LETTERS = 25.0, 0.25
#: A segment has the greatest sum of ratios above PART_BIAS, ends where it falls by PART_DROP, and takes MIN_PART characters.
PART_BIAS, PART_DROP, MIN_PART = 0.5, 20.0, 16
#: Stands for the ratio of a pair that no segment may cross: at `=` and at base spans.
BREAK = -1e6
SMOOTHING = 0.1
#: Labelled samples per class; a bound on the training set, not on the texts.
SAMPLES = 3000
PLACEHOLDER = "[secret]"
# Parts of ordinary identifiers.
IDENTIFIER_WORDS = (
    "get set user name file path index count value key item list map node tree data table column row field type class "
    "object string number date time start end first last next previous total size length width height color image text "
    "page view model controller service client server request response message error handler manager factory builder "
    "parser reader writer buffer stream channel queue event listener config option default custom internal external "
    "public private session account order payment invoice product category customer address country language version "
    "update delete insert select create remove find search filter sort group merge split join open close read write"
).split()


def labelled_samples(spark: SparkSession, count: int = SAMPLES) -> DataFrame:
    """(text, label): random strings of several alphabets (1) and identifiers of several styles (0), `count` of each."""
    ids = spark.range(count)
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 512)
    style = F.col("id") % 4
    random = F.when(style == 0, F.substring(digest, 1, 40)).when(
        style == 1, F.upper(F.substring(F.regexp_replace(F.base64(F.unhex(digest)), "[+/=]", ""), 1, 32))
    ).otherwise(F.substring(F.regexp_replace(F.base64(F.unhex(digest)), "\\s", ""), 1, 44))
    words = F.array(*map(F.lit, IDENTIFIER_WORDS))

    def word(k: int) -> Column:
        return F.get(words, F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(IDENTIFIER_WORDS))).cast("int"))

    parts = [word(k) for k in range(4)]
    number = F.when(F.col("id") % 3 == 0, (F.col("id") % 1000).cast("string")).otherwise("")
    camel = F.concat(parts[0], *map(F.initcap, parts[1:]), number)
    ordinary = (
        F.when(style == 0, F.concat(F.concat_ws("_", *parts), number))
        .when(style == 1, camel)
        .when(style == 2, F.concat_ws("/", *parts))
        .otherwise(F.upper(F.concat_ws("_", *parts)))
    )
    return ids.select(random.alias("text"), F.lit(1).alias("label")).unionByName(
        ids.select(ordinary.alias("text"), F.lit(0).alias("label"))
    )


def _place(c: Column) -> Column:
    return F.instr(F.lit(ALPHABET), c)


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios log P(b|a, random) - log P(b|a, ordinary) of all character pairs, row by row.

    Counted in Spark; the driver gets at most one number per label and pair. Characters outside the alphabet, null
    texts and labels other than 0 and 1 are left out; without samples all ratios are 0.
    """
    size = len(ALPHABET)
    pairs = samples.where("length(text) > 1 and label in (0, 1)").select(
        "label",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("text") - 1),
                lambda i: F.struct(_place(F.substring("text", i, 1)).alias("a"), _place(F.substring("text", i + 1, 1)).alias("b")),
            )
        ).alias("p"),
    )
    counts = pairs.where("p.a > 0 and p.b > 0").groupBy("label", "p.a", "p.b").count().collect()
    tables = [[[0] * size for _ in range(size)] for _ in range(2)]
    for r in counts:
        tables[r["label"]][r["a"] - 1][r["b"] - 1] = r["count"]

    def log_share(label: int, a: int, b: int) -> float:
        row = tables[label][a]
        return math.log((row[b] + SMOOTHING) / (sum(row) + SMOOTHING * size))

    return [log_share(1, a, b) - log_share(0, a, b) for a in range(size) for b in range(size)]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, start: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each value the sum, or what `add` makes, of those before it; block by block, so that no long list is copied often."""

    def scan(part: Column, first: Column) -> Column:
        state = F.struct(first.alias("at"), F.slice(F.array(first), 1, 0).alias("out"))
        return F.aggregate(
            part, state, lambda acc, v: F.struct(add(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        )

    def of(held: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(held), F.lit(1)), F.lit(_BLOCK))

        def shifted(blocks: Column) -> Column:
            offsets = scan(F.transform(blocks, lambda block: block["at"]), start)["out"]
            return F.flatten(F.zip_with(blocks, offsets, lambda block, o: F.transform(block["out"], lambda v: add(o, v))))

        return _let(F.transform(starts, lambda i: scan(F.slice(held, i, _BLOCK), start)), shifted)

    return _let(
        F.transform(values, lambda v: v), lambda held: F.when(F.size(held) > 0, of(held)).otherwise(F.slice(F.array(start), 1, 0))
    )


def _below(sorted_values: Column, limit: Column) -> Column:
    """How many of the sorted values are less than the limit, by halving."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(sorted_values) + 1.0)).cast("int"))
    state = F.struct(F.lit(0).alias("low"), F.size(sorted_values).alias("high"))

    def step(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        less = (acc["low"] < acc["high"]) & (F.get(sorted_values, middle) < limit)
        return F.struct(
            F.when(less, middle + 1).otherwise(acc["low"]).alias("low"),
            F.when(less | (acc["low"] >= acc["high"]), acc["high"]).otherwise(middle).alias("high"),
        )

    return F.aggregate(steps, state, step, lambda acc: acc["low"])


def _table(ratios: list[float]) -> Column:
    return F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")


def _places(run: Column) -> Column:
    """Number of each character in the alphabet, from 1; 0 outside it."""
    return F.transform(F.split(run, ""), _place)


def _mean(places: Column, ratios: list[float]) -> Column:
    """Mean ratio over the character pairs of a run of the alphabet, given by its characters' numbers."""
    table = _table(ratios)
    total = F.aggregate(
        F.sequence(F.lit(1), F.size(places) - 1),
        F.lit(0.0),
        lambda acc, i: acc + F.get(table, (F.get(places, i - 1) - 1) * len(ALPHABET) + F.get(places, i) - 1),
    )
    return total / (F.size(places) - 1)


def mean_ratio(run: Column, ratios: list[float]) -> Column:
    """Mean ratio over the character pairs of a run of the alphabet."""
    return _let(_places(run), lambda places: _mean(places, ratios))


def _pair_ratios(places: Column, ratios: list[float]) -> Column:
    """Ratio of each character pair of a run of two or more, BREAK beside `=` and outside the alphabet."""
    table = _table(ratios)
    broken = (0, ALPHABET.index("=") + 1)

    def ratio(i: Column) -> Column:
        a, b = F.get(places, i - 1), F.get(places, i)
        return F.when(a.isin(*broken) | b.isin(*broken), F.lit(BREAK)).otherwise(
            F.get(table, (a - 1) * len(ALPHABET) + b - 1)
        )

    return F.transform(F.sequence(F.lit(1), F.size(places) - 1), ratio)


def _rising(pairs: Column) -> Column:
    """(start, end, sum) of the segments, in characters, that a random part of MIN_PART characters must reach."""
    none = F.array().cast("array<struct<start:int,end:int,sum:double>>")
    state = F.struct(
        F.lit(0.0).alias("total"), F.lit(0.0).alias("peak"), F.lit(0).alias("start"), F.lit(0).alias("end"), none.alias("out")
    )

    def step(acc: Column, i: Column) -> Column:
        total = acc["total"] + F.coalesce(F.get(pairs, i), F.lit(BREAK)) - PART_BIAS
        held = acc["peak"] + PART_BIAS * (acc["end"] - acc["start"])
        high = acc["peak"] >= (MIN_RATIO - PART_BIAS) * (MIN_PART - 1)
        found = F.array(F.struct(acc["start"].alias("start"), (acc["end"] + 1).alias("end"), held.alias("sum")))
        return F.when(
            (total <= 0) | (total <= acc["peak"] - PART_DROP),
            F.struct(
                F.lit(0.0).alias("total"), F.lit(0.0).alias("peak"), (i + 1).alias("start"), (i + 1).alias("end"),
                F.when(high, F.concat(acc["out"], found)).otherwise(acc["out"]).alias("out"),
            ),
        ).otherwise(
            F.struct(
                total.alias("total"), F.greatest(total, acc["peak"]).alias("peak"), acc["start"].alias("start"),
                F.when(total > acc["peak"], i + 1).otherwise(acc["end"]).alias("end"), acc["out"].alias("out"),
            )
        )

    return F.aggregate(F.sequence(F.lit(0), F.size(pairs)), state, step, lambda acc: acc["out"])


def _mixed(run: Column) -> Column:
    return run.rlike("[0-9]") & run.rlike("[A-Za-z]")


def random_parts(run: Column, ratios: list[float]) -> Column:
    """(start, end) of random segments of a run, grown or cut to the `=`, `/`, `_` and `-` next to their ends.

    Characters outside the alphabet, as a space, belong to no segment. Marks and other places are looked up in sorted
    lists, so that the work grows with the run and not with its square.
    """
    marks = " =/_-"

    def found(chars: Column, places: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(chars) - 1)
        # where a segment's first or last word ends: behind a mark, or at one
        borders = F.filter(at, lambda i: F.instr(F.lit(marks), F.get(chars, i)) > 0)
        unequal = F.filter(at, lambda i: F.get(chars, i) != "=")

        def ends(segment: Column, borders: Column, unequal: Column) -> Column:
            n_before = _below(borders, segment["start"])
            left = segment["start"] - F.when(n_before > 0, F.get(borders, n_before - 1) + 1).otherwise(0)
            stop = F.coalesce(F.get(borders, _below(borders, segment["end"])), F.size(chars))
            right = stop - segment["end"]
            held = F.array_join(F.slice(chars, segment["start"] + 1, segment["end"] - segment["start"]), "")
            # a few characters of a neighbour that is only touched go with the mark between
            lead = F.when(left == 0, F.regexp_extract(held, "^[=/_-]*", 0)).otherwise(
                F.regexp_extract(held, "^(?:[^=/_-]{0,3}[=/_-]+)?", 0)
            )
            trail = F.when(right == 0, F.regexp_extract(held, "(?<![=/_-])[=/_-]*+$", 0)).otherwise(
                F.regexp_extract(held, "(?<![=/_-])(?:[=/_-]++[^=/_-]{0,3})?$", 0)
            )
            grown = F.coalesce(F.get(unequal, _below(unequal, stop)), F.size(chars)) - segment["end"]
            return F.struct(
                (segment["start"] + F.when(lead != "", F.length(lead)).otherwise(-left)).alias("start"),
                (segment["end"] + F.when(trail != "", -F.length(trail)).otherwise(grown)).alias("end"),
                (_mixed(held) & (segment["sum"] >= F.greatest(F.lit(PART_SUM), MIN_RATIO * (F.length(held) - 1)))).alias("high"),
            )

        def alone(part: Column, start: Column, size: Column) -> Column:
            letters = F.length(F.regexp_replace(part, "[^A-Za-z]", ""))
            dense = _mixed(part) & (letters >= PART_LETTERS * F.length(part))
            return F.when(dense, _let(F.slice(places, start, size), lambda own: _mean(own, ratios)) >= MIN_RATIO).otherwise(False)

        def is_random(x: Column) -> Column:
            start, size = x["start"] + 1, x["end"] - x["start"]
            return x["high"] | _let(F.array_join(F.slice(chars, start, size), ""), lambda part: alone(part, start, size))

        nothing = F.array().cast("array<struct<start:int,end:int,high:boolean>>")

        def grow(rising: Column) -> Column:
            looked_up = _let(borders, lambda b: _let(unequal, lambda u: F.transform(rising, lambda x: ends(x, b, u))))
            return F.when(F.size(rising) > 0, looked_up).otherwise(nothing)

        grown = _let(_let(_pair_ratios(places, ratios), _rising), grow)
        long_enough = F.filter(grown, lambda x: x["end"] - x["start"] >= MIN_PART)
        return F.array_distinct(F.transform(F.filter(long_enough, is_random), lambda x: F.struct(x["start"], x["end"])))

    return _let(
        F.transform(F.split(run, ""), lambda c: c),
        lambda chars: _let(F.transform(chars, _place), lambda places: found(chars, places)),
    )


def _hits(rows: DataFrame, name: str, text: Column, pattern: str, present: Column) -> DataFrame:
    """Add arrays of a pattern's matches and of the pieces between them, null where there is none."""
    return rows.withColumn(f"_{name}_hits", F.when(present, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))).withColumn(
        f"_{name}_gaps", F.when(present, F.split(text, pattern, -1))
    )


def _spans(name: str) -> Column:
    """Places of the matches in code points: lengths of gaps and matches, added up."""
    hits, gaps = F.col(f"_{name}_hits"), F.col(f"_{name}_gaps")
    steps = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda gap, hit: F.length(gap) + F.length(hit))
    starts = _running(steps, F.lit(0), lambda a, b: a + b)
    before = F.zip_with(starts, F.slice(gaps, 1, F.size(hits)), lambda at, gap: at + F.length(gap))
    found = F.zip_with(
        before,
        hits,
        lambda start, hit: F.struct(
            start.alias("start"), F.lit(KINDS.index(name)).alias("kind"), (start + F.length(hit)).alias("end")
        ),
    )
    return F.when(F.size(hits) > 0, found).otherwise(F.lit(None).cast("array<struct<start:int,kind:int,end:int>>"))


def _merged(spans: Column) -> Column:
    """Sorted spans as (start, end) of those that overlap together."""

    def of(held: Column, reached: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(held) - 1), lambda i: F.get(held, i)["start"] >= F.get(reached, i))
        whole = F.greatest(F.get(reached, F.size(held) - 1), F.get(held, F.size(held) - 1)["end"])
        return _let(
            first,
            lambda f: F.transform(
                f,
                lambda i, k: F.struct(
                    F.get(held, i)["start"].alias("start"),
                    F.when(k + 1 < F.size(f), F.get(reached, F.get(f, k + 1))).otherwise(whole).alias("end"),
                ),
            ),
        )

    def with_reached(held: Column) -> Column:
        return _let(_running(F.transform(held, lambda s: s["end"]), F.lit(-1), F.greatest), lambda reached: of(held, reached))

    empty = F.array().cast("array<struct<start:int,end:int>>")
    return F.when(F.size(spans) > 0, _let(F.transform(spans, lambda s: s), with_reached)).otherwise(empty)


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def scan_secrets(docs: DataFrame, ratios: list[float], text_col: str = "text") -> DataFrame:
    """The rows with secret_spans: array of (start, kind, end) in code points, sorted by start and kind.

    Base kinds are matched from the left without overlap per kind; `markov` are runs that the models call random and
    random parts of the other runs, beside names and paths. Runs are looked for where base spans are blanked out, so
    that a run that a base span touches is judged by the pieces that are left; no `markov` span overlaps a base span.
    Whole texts are read, row by row and without a shuffle; the work grows with the length of a text and its number of
    spans. Null and empty texts have no spans, repeated rows equal ones, other columns are carried along, an empty table
    gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = _hits(docs, "assign", text, ASSIGN, text.rlike(ASSIGN))
    rows = rows.withColumn(
        "_assigned", F.when(F.size("_assign_hits") > 0, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)))
    )
    rows = _hits(rows, "access", text, ACCESS, text.contains("AKIA") & text.rlike(ACCESS))
    rows = _hits(rows, "hex", text, HEX, text.rlike(HEX))
    for name in KINDS[:3]:
        rows = rows.withColumn(f"_{name}", _spans(name))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    long_enough = F.filter("_assign", lambda s, i: F.length(F.get(F.col("_assigned"), i)) >= MIN_ASSIGNED)
    base = F.concat(F.coalesce(long_enough, none), F.coalesce("_access", none), F.coalesce("_hex", none))
    rows = rows.withColumn("_base", F.array_sort(base))

    # the text with blanks for base spans, of the same length
    kept = F.zip_with(
        F.slice("_assign_gaps", 1, F.size("_assign_hits")),
        F.arrays_zip(F.col("_assign_hits").alias("hit"), F.col("_assigned").alias("value")),
        lambda gap, m: F.concat(
            gap, F.when(F.length(m["value"]) >= MIN_ASSIGNED, F.repeat(F.lit(BLANK), F.length(m["hit"]))).otherwise(m["hit"])
        ),
    )
    rest = F.when(
        F.size("_assign_hits") > 0, F.concat(F.array_join(kept, ""), F.element_at("_assign_gaps", -1))
    ).otherwise(text)
    rest = F.when(F.col("_access").isNotNull(), F.regexp_replace(rest, _ACCESS_CHARS, BLANK)).otherwise(rest)
    rest = F.when(F.col("_hex").isNotNull(), F.regexp_replace(rest, _HEX_CHARS, BLANK)).otherwise(rest)
    rows = rows.withColumn("_rest", rest)
    either = f"{CANDIDATE}|{_BESIDE_BLANK}"
    rows = _hits(rows, "markov", F.col("_rest"), either, F.col("_rest").rlike(either))
    rows = rows.withColumn("_markov", _spans("markov"))

    def random(span: Column, i: Column) -> Column:
        run = F.get(F.col("_markov_hits"), i)
        beside = F.get(F.col("_markov_gaps"), i).endswith(BLANK) | F.get(F.col("_markov_gaps"), i + 1).startswith(BLANK)
        parts = F.transform(
            random_parts(run, ratios),
            lambda p: F.struct(
                (span["start"] + p["start"]).alias("start"), F.lit(KINDS.index("markov")).alias("kind"),
                (span["start"] + p["end"]).alias("end"),
            ),
        )
        whole = ~beside & (mean_ratio(run, ratios) >= MIN_RATIO)
        return F.when(_mixed(run), F.when(whole, F.array(span)).otherwise(parts)).otherwise(none)

    # blanking one kind may leave too little of another that it overlaps; what the models make of that is dropped
    def clear(spans: Column) -> Column:
        def of(starts: Column, ends: Column) -> Column:
            return F.filter(spans, lambda s: _below(starts, s["end"]) <= _below(ends, s["start"] + 1))

        held = _merged(F.col("_base"))
        apart = _let(
            held,
            lambda b: _let(
                F.transform(b, lambda s: s["start"]),
                lambda starts: _let(F.transform(b, lambda s: s["end"]), lambda ends: of(starts, ends)),
            ),
        )
        return F.when((F.size(spans) > 0) & (F.size("_base") > 0), apart).otherwise(spans)

    rows = rows.withColumn("_random", F.coalesce(F.flatten(F.transform("_markov", random)), none))
    rows = rows.withColumn("secret_spans", F.array_sort(F.concat("_base", clear(F.col("_random")))))
    return rows.drop(
        "_assigned", "_base", "_rest", "_random", *[f"_{n}{s}" for n in KINDS for s in ("", "_hits", "_gaps")]
    )


def span_digest(rows: DataFrame) -> DataFrame:
    """n_assign, n_access, n_hex, base_sha256 and spans of scanned rows, with doc_id."""
    base = F.filter("secret_spans", lambda s: s["kind"] < 3)

    def count(kind: int) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")

    return rows.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("secret_spans")).alias("spans"),
    )


def redact(rows: DataFrame, text_col: str = "text", placeholder: str = PLACEHOLDER) -> DataFrame:
    """Scanned rows with every span of their text replaced; overlapping spans become one placeholder.

    The text is rebuilt in chunks, each from the spans that reach into it.
    """
    text = F.col(text_col)

    def chunk(part: Column, k: Column, spans: Column, starts: Column, ends: Column) -> Column:
        first = k * _CHUNK
        low, high = _below(ends, first + 1), _below(starts, first + F.length(part))
        state = F.struct(first.alias("at"), F.lit("").alias("out"))
        return F.aggregate(
            F.slice(spans, low + 1, F.greatest(high - low, F.lit(0))),
            state,
            lambda acc, s: F.struct(
                F.least(s["end"], first + F.length(part)).alias("at"),
                F.concat(
                    acc["out"],
                    F.when(
                        s["start"] >= first,
                        F.concat(F.substring(part, acc["at"] - first + 1, s["start"] - acc["at"]), F.lit(placeholder)),
                    ).otherwise(""),
                ).alias("out"),
            ),
            lambda acc: F.concat(acc["out"], F.substring(part, acc["at"] - first + 1, F.length(part))),
        )

    def rebuilt(spans: Column, starts: Column, ends: Column) -> Column:
        parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0))
        return F.array_join(F.transform(parts, lambda part, k: chunk(part, k, spans, starts, ends)), "")

    joined = _let(
        _merged(F.col("secret_spans")),
        lambda m: _let(
            F.transform(m, lambda s: s["start"]), lambda a: _let(F.transform(m, lambda s: s["end"]), lambda b: rebuilt(m, a, b))
        ),
    )
    return rows.withColumn(text_col, F.when(F.size("secret_spans") > 0, joined).otherwise(text)).drop("secret_spans")
