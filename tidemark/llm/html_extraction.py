"""Main text of web pages: a linear-chain conditional random field over leaf blocks, decoded by Viterbi."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.html_blocks import Block, read_blocks
from tidemark.llm.labelled_pages import CONTENT_MARK, labelled_pages

#: Labelled pages that the model is fitted on, and passes over them.
TRAINING_PAGES, EPOCHS = 500, 6
_RATE, _DECAY = 0.4, 1e-4
# Words that are frequent in what stands around articles.
CHROME_WORDS = frozenset(
    "cookies cookie subscribe newsletter copyright rights reserved login sign register advertisement sponsored share "
    "comments comment reply menu home contact privacy terms search follow".split()
)

Weights = dict[str, float]


def block_features(block: Block) -> list[str]:
    """Ancestor tags and hints, the block's own element, and what its text looks like."""
    words = block.text.split()
    count = len(words)
    link_share = block.linked / max(1, len(block.text))
    chrome = sum(w.strip(".,:;!?()").lower() in CHROME_WORDS for w in words)
    found = [*block.around, f"own:{block.tag}", "bias"]
    found.append("w:1-3" if count < 4 else "w:4-9" if count < 10 else "w:10-24" if count < 25 else "w:25+")
    found.append("l:none" if link_share == 0 else "l:some" if link_share < 0.5 else "l:most")
    found.append("e:mark" if block.text[-1] in ".!?…:;\"'”’»)" else "e:open")
    if chrome:
        found.append("k:chrome" if chrome * 6 < count else "k:mostly")
    if "©" in block.text:
        found.append("k:copyright")
    if block.text.count("|") + block.text.count("»") >= 2:
        found.append("k:bars")
    return found


def _edge(before: Block, block: Block, first: int, second: int) -> str:
    return f"{'near' if before.container == block.container else 'far'}:{first}{second}"


def _scores(blocks: list[Block], weights: Weights) -> tuple[list[float], list[tuple[float, float, float, float]]]:
    """Score of label 1 against label 0 for each block, and of the four label pairs for each step."""
    get = weights.get
    units = [sum([get(f, 0.0) for f in block_features(b)]) for b in blocks]
    steps = [
        tuple(get(_edge(a, b, x, y), 0.0) for x in (0, 1) for y in (0, 1)) for a, b in zip(blocks, blocks[1:])
    ]
    return units, steps


def decode(blocks: list[Block], weights: Weights) -> list[int]:
    """The most probable labels of all blocks together (Viterbi); 1 is main text."""
    if not blocks:
        return []
    units, steps = _scores(blocks, weights)
    zero, one = 0.0, units[0]
    back = []
    for unit, (s00, s01, s10, s11) in zip(units[1:], steps):
        back.append((zero + s00 < one + s10, zero + s01 < one + s11))
        zero, one = max(zero + s00, one + s10), unit + max(zero + s01, one + s11)
    labels = [int(one > zero)]
    for step in reversed(back):
        labels.append(int(step[labels[-1]]))
    return labels[::-1]


def _add(a: float, b: float) -> float:
    high = max(a, b)
    return high + math.log1p(math.exp(min(a, b) - high))


def _gradient(blocks: list[Block], labels: list[int], weights: Weights) -> dict[str, float]:
    """Observed minus expected features of one page, by forward and backward sums."""
    units, steps = _scores(blocks, weights)
    n = len(blocks)
    ahead = [(0.0, units[0])]
    for unit, (s00, s01, s10, s11) in zip(units[1:], steps):
        a, b = ahead[-1]
        ahead.append((_add(a + s00, b + s10), unit + _add(a + s01, b + s11)))
    behind = [(0.0, 0.0)]
    for i in range(n - 2, -1, -1):
        s00, s01, s10, s11 = steps[i]
        a, b = behind[-1]
        b += units[i + 1]
        behind.append((_add(s00 + a, s01 + b), _add(s10 + a, s11 + b)))
    behind.reverse()
    total = _add(*ahead[-1])
    out: dict[str, float] = defaultdict(float)
    for i, block in enumerate(blocks):
        miss = labels[i] - math.exp(ahead[i][1] + behind[i][1] - total)
        if abs(miss) > 1e-4:
            for f in block_features(block):
                out[f] += miss
        if i + 1 < n:
            following = (0.0, units[i + 1])
            for x in (0, 1):
                for y in (0, 1):
                    expected = math.exp(ahead[i][x] + steps[i][2 * x + y] + following[y] + behind[i + 1][y] - total)
                    out[_edge(block, blocks[i + 1], x, y)] += (labels[i] == x and labels[i + 1] == y) - expected
    return out


def fit(pages: Iterable[str], epochs: int = EPOCHS) -> Weights:
    """Weights of the field from labelled pages: HTML in which the text of content blocks begins with CONTENT_MARK.

    Maximum likelihood with adaptive steps and a small decay, page by page in the given order, so that equal pages give
    equal weights. Pages without blocks say nothing.
    """
    examples = []
    for page in pages:
        blocks = read_blocks(page)
        labels = [int(b.text.startswith(CONTENT_MARK)) for b in blocks]
        blocks = [b._replace(text=b.text.replace(CONTENT_MARK, "").strip()) for b in blocks]
        kept = [(b, y) for b, y in zip(blocks, labels) if b.text]
        if kept:
            examples.append(([b for b, _ in kept], [y for _, y in kept]))
    weights: Weights = defaultdict(float)
    squares: dict[str, float] = defaultdict(float)
    for _ in range(epochs):
        for blocks, labels in examples:
            for name, slope in _gradient(blocks, labels, weights).items():
                slope -= _DECAY * weights[name]
                squares[name] += slope * slope
                weights[name] += _RATE * slope / math.sqrt(squares[name] + 1e-8)
    return dict(weights)


@lru_cache(maxsize=1)
def default_weights() -> Weights:
    """Weights fitted on TRAINING_PAGES labelled pages, once per process."""
    return fit(labelled_pages(TRAINING_PAGES))


def main_text(page: str | None, weights: Weights) -> str:
    """Content blocks of one page, joined by line ends; null and pages without content give an empty text."""
    blocks = read_blocks(page or "")
    return "\n".join(b.text for b, y in zip(blocks, decode(blocks, weights)) if y)


def extract_main_text(pages: DataFrame, weights: Weights | None = None, html_col: str = "html") -> DataFrame:
    """The rows, without the HTML column, with text and n_chars (code points).

    The whole page is read, of any length. A null page counts as empty; repeated rows get equal texts; other columns are
    carried along unless they are called text or n_chars, which are replaced; an empty table gives an empty result.
    The weights are some hundred numbers and travel with the task. No shuffle.
    """
    model = default_weights() if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = [main_text(page, model) for page in part.column(0).to_pylist()]
                counts = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(texts, pa.string()), counts], [*part.schema.names[1:], "text", "n_chars"]
                )

    others = [f for f in pages.schema.fields if f.name not in (html_col, "text", "n_chars")]
    source = pages.select(F.col(html_col).alias("_page"), *[F.col(f"`{f.name}`") for f in others])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others] + ["text string", "n_chars long"])
    return source.mapInArrow(run, schema)
