"""Text quality by a generalised additive model with pairwise interactions.

The model is a sum of lookup tables: one per feature over its bins, and one per chosen pair of
features over a coarse grid. Boosting goes round the features in turn, each time adding a small
step of a tree of four leaves on that feature alone; then the pairs that explain most of what is
left get trees that cut once in either direction. A score is the sum of the tables' entries at
the document's bins, done for a whole batch by array indexing.

Only fitting sees labels. It takes at most ``Fit.rows`` labelled documents, those whose hashed
doc_id comes first: their number, not the corpus, bounds what reaches the driver. Features come from the text alone.

Defined results: a null text is empty; every text, empty ones too, has a score. Null labels and rows
that repeat a labelled doc_id with another label are each an example of their own or none. Without labels of both
kinds the score is their mean, or 0.5. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import ship
from tabloom.llm.divergence_rules import COMMON_WORDS

_COMMON = frozenset(w for words in COMMON_WORDS.values() for w in words)
_EDGES = ".,;:!?'\"()"
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "line_end": b"\n",
    "stop": b".,;:",
    "mark": b"!?",
    "bar": b"|",
    "symbol": b"#*$%&<>{}[]=_~^\\/",
    "wide": bytes(range(128, 256)),
}

FEATURES = (
    "words",
    "word_length",
    "distinct_words",
    "top_word",
    "same_as_before",
    "repeated_pairs",
    "duplicate_lines",
    "common_words",
    "capital_words",
    "odd_endings",
    "short_words",
    "long_words",
    "line_words",
    "entropy",
    *_CLASSES,
)
_TABLE = np.zeros((256, len(_CLASSES)))
for _place, _bytes in enumerate(_CLASSES.values()):
    _TABLE[list(_bytes), _place] = 1.0


class Fit(NamedTuple):
    """How the model is fitted; ``rows`` bounds the labelled sample."""

    rows: int = 20_000
    bins: int = 32
    rounds: int = 150
    step: float = 0.1
    pairs: int = 8
    grid: int = 8
    pair_rounds: int = 60
    least_rows: int = 10
    shrink: float = 2.0


class Model(NamedTuple):
    start: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]


def features_of(text: str) -> list[float]:
    """The numbers the model sees of one text, in the order of FEATURES."""
    data = np.frombuffer(text.encode(), np.uint8)
    counts = np.bincount(data, minlength=256)
    size = max(1, len(data))
    shares = counts[counts > 0] / size
    entropy = float(-(shares * np.log2(shares)).sum()) if len(data) else 0.0
    words = text.split()
    n = max(1, len(words))
    seen = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    lines = [line for line in text.split("\n") if line.strip()]
    length = sum(map(len, words))
    bare = Counter()
    for word, times in seen.items():
        bare["common"] += times * (word.strip(_EDGES).lower() in _COMMON)
        bare["capital"] += times * (len(word) > 1 and word.isupper())
        bare["odd"] += times * (not word[-1].isalnum() and word[-1] not in ".,")
        bare["short"] += times * (len(word) <= 3)
        bare["long"] += times * (len(word) >= 12)
    return [
        float(np.log1p(len(words))),
        length / n,
        len(seen) / n,
        max(seen.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        sum(c for c in pairs.values() if c > 1) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        bare["common"] / n,
        bare["capital"] / n,
        bare["odd"] / n,
        bare["short"] / n,
        bare["long"] / n,
        float(np.log1p(len(words) / max(1, len(lines)))),
        entropy,
        *((counts @ _TABLE) / size).tolist(),
    ]


def _tree(gradient: np.ndarray, weight: np.ndarray, shrink: float, depth: int = 2) -> np.ndarray:
    """Values per bin of a tree of 2**depth leaves on one feature, from sums per bin."""
    g, h = np.cumsum(gradient), np.cumsum(weight)
    if depth and len(gradient) > 1:
        gain = g[:-1] ** 2 / (h[:-1] + shrink) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + shrink)
        cut = int(np.argmax(gain)) + 1
        if gain[cut - 1] > g[-1] ** 2 / (h[-1] + shrink) + 1e-9:
            sides = ((gradient[:cut], weight[:cut]), (gradient[cut:], weight[cut:]))
            return np.concatenate([_tree(a, b, shrink, depth - 1) for a, b in sides])
    return np.full(len(gradient), g[-1] / (h[-1] + shrink))


def _grid_tree(gradient: np.ndarray, weight: np.ndarray, shrink: float) -> tuple[float, np.ndarray]:
    """Gain and values per cell of the best tree that cuts a grid once in either direction."""
    g, h = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (gradient, weight))
    inner = (slice(1, -1), slice(1, -1))

    def quarters(s: np.ndarray) -> list[np.ndarray]:
        both, left, top, all_ = s[inner], s[1:-1, -1:], s[-1:, 1:-1], s[-1, -1]
        return [both, left - both, top - both, all_ - left - top + both]

    gain = sum(a**2 / (b + shrink) for a, b in zip(quarters(g), quarters(h), strict=True))
    i, j = np.unravel_index(np.argmax(gain), gain.shape)
    values = np.empty_like(gradient)
    places = [(slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None))]
    places += [(slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None))]
    for place, a, b in zip(places, quarters(g), quarters(h), strict=True):
        values[place] = a[i, j] / (b[i, j] + shrink)
    return float(gain[i, j] - g[-1, -1] ** 2 / (h[-1, -1] + shrink)), values


def _quantile_cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray, how: Fit = Fit()) -> Model:
    """The model of rows of features and labels 0 and 1."""
    mean = float(y.mean()) if len(y) else 0.5
    if len(y) < how.least_rows or mean in (0.0, 1.0):
        odds = min(max(mean, 1e-6), 1 - 1e-6)
        return Model(float(np.log(odds / (1 - odds))), [np.empty(0)] * x.shape[1], [np.zeros(1)] * x.shape[1], [])
    start = float(np.log(mean / (1 - mean)))
    cuts = [_quantile_cuts(x[:, f], how.bins) for f in range(x.shape[1])]
    bins = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    score = np.full(len(y), start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-score))
        return y - p, p * (1 - p)

    for _ in range(how.rounds):
        for table, place in zip(tables, bins, strict=True):
            g, h = slopes()
            sums = (np.bincount(place, s, len(table)) for s in (g, h))
            change = how.step * _tree(*sums, how.shrink)
            table += change
            score += change[place]

    coarse_cuts = [_quantile_cuts(x[:, f], how.grid) for f in range(x.shape[1])]
    coarse = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(coarse_cuts)]

    def pair_tree(a: int, b: int, g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        shape = (len(coarse_cuts[a]) + 1, len(coarse_cuts[b]) + 1)
        cell = coarse[a] * shape[1] + coarse[b]
        sums = (np.bincount(cell, s, shape[0] * shape[1]).reshape(shape) for s in (g, h))
        return *_grid_tree(*sums, how.shrink), cell

    usable = [f for f in range(x.shape[1]) if len(coarse_cuts[f])]
    g, h = slopes()
    ranked = sorted(combinations(usable, 2), key=lambda p: -pair_tree(*p, g, h)[0])[: how.pairs]
    grids = {p: np.zeros((len(coarse_cuts[p[0]]) + 1, len(coarse_cuts[p[1]]) + 1)) for p in ranked}
    for _ in range(how.pair_rounds):
        for pair, grid in grids.items():
            _, values, cell = pair_tree(*pair, *slopes())
            grid += how.step * values
            score += how.step * values.ravel()[cell]
    return Model(
        start, cuts, tables, [(a, b, coarse_cuts[a], coarse_cuts[b], grid) for (a, b), grid in grids.items()]
    )


def score(model: Model, x: np.ndarray) -> np.ndarray:
    """0 to 1 for each row of features: the tables' entries at its bins, added up."""
    total = np.full(len(x), model.start)
    for f, (cuts, table) in enumerate(zip(model.cuts, model.tables, strict=True)):
        total += table[np.searchsorted(cuts, x[:, f], side="right")]
    for a, b, cuts_a, cuts_b, grid in model.pairs:
        total += grid[np.searchsorted(cuts_a, x[:, a], side="right"), np.searchsorted(cuts_b, x[:, b], side="right")]
    return 1 / (1 + np.exp(-total))


def _matrix(texts: pa.Array) -> np.ndarray:
    rows = [features_of(texts[i].as_py() or "") for i in range(len(texts))]
    return np.array(rows, float).reshape(len(rows), len(FEATURES))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _matrix(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x.tolist(), pa.list_(pa.float64()))], ["y", "x"])


def _score_rows(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(model, _matrix(batch.column(1))))], ["id", "s"])


def train(
    documents: DataFrame, labels: DataFrame, label: str, how: Fit = Fit(), key: str = "doc_id", text: str = "text"
) -> Model:
    """Fit on the labelled documents: ``labels`` has ``key`` and ``label``, of rows that may be learned from."""
    ship(documents.sparkSession)
    # bounded by how.rows, so it may be sent to every task: the documents are not shuffled
    sample = (
        labels.select(F.col(key).alias("_key"), F.col(label).cast("double").alias("_y"))
        .where("_key is not null and _y is not null")
        .orderBy(F.xxhash64("_key"), "_key", "_y")
        .limit(how.rows)
    )
    # rows that share a key and a label are one example, reduced in the tasks that read them
    own = F.coalesce(F.col(text), F.lit(""))
    picked = (
        documents.select(F.col(key).alias("_key"), own.alias("_text"))
        .join(F.broadcast(sample), "_key")
        .groupBy("_key", "_y")
        .agg(F.min_by("_text", F.struct(F.xxhash64("_text"), F.length("_text"))).alias("_text"))
        .select("_y", "_text")
    )
    rows = picked.mapInArrow(_feature_rows, "y double, x array<double>").toArrow()
    y = rows["y"].to_numpy()
    x = np.array(rows["x"].to_pylist(), float).reshape(len(y), len(FEATURES))
    order = np.lexsort([*x.T, y])  # whatever order the tasks ended in
    return fit(x[order], y[order], how)


def score_documents(
    documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key`` and score of every document."""
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()
    return (
        documents.select(key, text)
        .mapInArrow(lambda batches: _score_rows(batches, model), f"id {kind}, score double")
        .withColumnRenamed("id", key)
    )


def held_out(key: Column | str, folds: int = 5) -> Column:
    """Rows no label is learned from: those whose key, as text, has a checksum divisible by ``folds``."""
    name = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    return F.crc32(F.encode(name, "utf-8")) % folds == 0
