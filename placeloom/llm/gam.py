"""Quality classifier: a generalised additive model with pairwise interactions over statistics of the whole text.

Boosting goes round the features in turn; each step fits a shallow tree to one feature's bins and adds it to that feature's
lookup table, so the model is a sum of tables. Then the pairs of features whose tables' residual shows most
structure get two-dimensional tables, boosted in the same way. Scoring bins the statistics of a batch and adds table entries.

The model is fitted on the driver from a bounded sample, ``sample`` labelled rows at most, those with the least hash of their id.

Defined results: a null text counts as empty, and empty texts are scored as any other; rows whose label is null or not 0 or 1
are not learnt from, nor are those of a null id; without labels every score is 0.5; null and repeated ids are scored each; an empty
table gives an empty result; other columns are ignored, and carried by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytetext import U, Words, mix, slices, text_bytes
from placeloom.plans.scratch import ship

FEATURES = (
    "words", "word_length", "symbols", "capitals", "bare_symbols", "digits", "distinct", "repeated_lines", "line_words",
    "stops", "odd_ends", "top_word", "short_words", "longest_word", "bars", "distinct_symbols_run", "repeated_runs",
)


def _class(chars: bytes | range | list[int]) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(chars)] = 1
    return out


_CAPITAL, _DIGIT = _class(range(65, 91)), _class(range(48, 58))
_LETTER = _class([*range(65, 91), *range(97, 123), *range(128, 256)])
_PLAIN_END = _class(b".,;:!?\"')").astype(bool)
_SYMBOL = 1 - np.minimum(1, _LETTER + _DIGIT + _class(b" \t\n\v\f\r.,"))
_STOPS = _class(b".,")


def _longest_share(doc: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: distinct values, and the count of its most frequent one."""
    order = np.lexsort((h, doc))
    d, v = doc[order], h[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(v)))
    top = np.zeros(rows, np.int64)
    np.maximum.at(top, d[at], size)
    return np.bincount(d[at], minlength=rows), top


def features(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text."""
    rows = len(at) - 1
    w = Words(raw, at)
    n = np.maximum(w.count, 1).astype(float)
    size = np.maximum(np.diff(at), 1).astype(float)

    def per_text(table: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(table[raw])])
        return (run[at[1:]] - run[at[:-1]]).astype(float)

    def per_word(x: np.ndarray) -> np.ndarray:
        return np.bincount(w.doc, x, minlength=rows)[:rows] if len(w.doc) else np.zeros(rows)

    length = w.end - w.start
    letters = per_text(_LETTER)
    known = np.concatenate([[0], np.cumsum(_LETTER[raw] + _DIGIT[raw])])
    bare = known[w.end] == known[w.start]
    last = raw[w.end - 1] if len(w.end) else raw[:0]
    odd = (_SYMBOL[last] == 1) & ~_PLAIN_END[last] & ~bare
    h = w.hashes()
    distinct, top = _longest_share(w.doc, h, rows)
    # lines: words are summed by line
    lines = np.concatenate([[0], np.cumsum(raw == 10)])
    line = lines[w.start] + w.doc if len(w.start) else w.start  # rows differ even without a line break
    longest = np.zeros(rows)
    np.maximum.at(longest, w.doc, length)
    n_lines = per_text(_class(b"\n")) + 1
    if len(h):
        first = np.ones(len(h), bool)
        first[1:] = (line[1:] != line[:-1]) | (w.doc[1:] != w.doc[:-1])
        starts = np.flatnonzero(first)
        text = mix(np.add.reduceat(mix(h + (np.arange(len(h)) - np.repeat(starts, np.diff(np.append(starts, len(h))))).astype(np.uint64) * U(0x9E3779B97F4A7C15)), starts))
        owner = w.doc[starts]
        different, _ = _longest_share(owner, text, rows)
        filled = np.bincount(owner, minlength=rows)
        again = (filled - different) / np.maximum(filled, 1)
        pair = np.flatnonzero(w.doc[:-2] == w.doc[2:]) if len(h) > 2 else np.zeros(0, np.int64)
        run = mix(h[pair] + mix(h[pair + 1] + mix(h[pair + 2])))
        runs, _ = _longest_share(w.doc[pair], run, rows)
        made = np.bincount(w.doc[pair], minlength=rows)
        runs_again = (made - runs) / np.maximum(made, 1)
    else:
        again = runs_again = np.zeros(rows)
    symbols = per_text(_SYMBOL)
    cols = [
        np.log1p(w.count), per_word(length.astype(float)) / n, symbols / size, per_text(_CAPITAL) / np.maximum(letters, 1), per_word(bare.astype(float)) / n,
        per_text(_DIGIT) / size, distinct / n, again, np.log1p(w.count / n_lines), per_text(_STOPS) / n, per_word(odd.astype(float)) / n, top / n,
        per_word((length <= 3).astype(float)) / n, longest, per_text(_class(b"|")) / n, symbols / n, runs_again,
    ]
    return np.stack(cols, 1)


@dataclass
class Gam:
    """intercept + sum of tables[f][bin of f] + sum of pairs[a, b][bin of a, bin of b], as log odds."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        bins = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)]
        for f, t in enumerate(self.tables):
            total += t[bins[f]]
        for (a, b), t in self.pairs.items():
            total += t[self.coarse[a][bins[a]], self.coarse[b][bins[b]]]
        return 1 / (1 + np.exp(-total))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """Values by bin of a tree with up to ``leaves`` leaves for gradient and curvature sums by bin."""
    g, h = np.append(0, np.cumsum(g)), np.append(0, np.cumsum(h))
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
    cuts = [0, len(g) - 1]
    for _ in range(leaves - 1):
        best = (1e-9, -1)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            at = np.arange(a + 1, b)
            at = at[(h[at] - h[a] >= least) & (h[b] - h[at] >= least)]
            if len(at):
                gains = (g[at] - g[a]) ** 2 / (h[at] - h[a] + 1) + (g[b] - g[at]) ** 2 / (h[b] - h[at] + 1) - gain(a, b)
                i = int(np.argmax(gains))
                best = max(best, (float(gains[i]), int(at[i])))
        if best[1] < 0:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g) - 1)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def _grid_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of a tree of depth two over a grid: the better of cutting rows, then columns of each side, or the other way."""

    def way(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
        best = (0.0, np.zeros_like(g))
        for cut in range(1, len(g)):
            value, gain = np.zeros_like(g), 0.0
            for side in (slice(0, cut), slice(cut, None)):
                a, b = np.cumsum(g[side].sum(0)), np.cumsum(h[side].sum(0))
                gains = a**2 / (b + 1) + (a[-1] - a) ** 2 / (b[-1] - b + 1)
                i = int(np.argmax(gains))
                gain += float(gains[i])
                value[side, : i + 1] = a[i] / (b[i] + 1)
                value[side, i + 1 :] = (a[-1] - a[i]) / (b[-1] - b[i] + 1)
            if gain > best[0]:
                best = (gain, value)
        return best

    (one, v), (two, t) = way(g, h), way(g.T, h.T)
    return v if one >= two else t.T


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.15, bins: int = 64, pairs: int = 4, pair_rounds: int = 40) -> Gam:
    model = Gam()
    ok = (y == 0) | (y == 1)
    x, y = x[ok], y[ok].astype(float)
    if not len(y):
        return model
    p = min(max(y.mean(), 1e-3), 1 - 1e-3)
    model.intercept = float(np.log(p / (1 - p)))
    n, m = x.shape
    model.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(m)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.coarse = [np.arange(len(e) + 1) * 8 // (len(e) + 1) for e in model.edges]
    at = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.edges)]
    total = np.full(n, model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-total))
        return y - q, np.maximum(q * (1 - q), 1e-6)

    for _ in range(rounds):
        for f in range(m):
            g, h = slopes()
            size = len(model.tables[f])
            step = rate * _tree(np.bincount(at[f], g, size), np.bincount(at[f], h, size), 4, 0.5)
            model.tables[f] += step
            total += step[at[f]]
    g, h = slopes()
    grid = {}
    for a in range(m):
        for b in range(a + 1, m):
            cell = model.coarse[a][at[a]] * 8 + model.coarse[b][at[b]]
            gg, hh = np.bincount(cell, g, 64), np.bincount(cell, h, 64)
            grid[a, b] = (float((gg**2 / (hh + 5.0)).sum()), cell)
    for key in sorted(grid, key=lambda k: -grid[k][0])[:pairs]:
        model.pairs[key] = np.zeros((8, 8))
    for _ in range(pair_rounds):
        for key, table in model.pairs.items():
            cell = grid[key][1]
            g, h = slopes()
            step = 0.5 * rate * _grid_tree(np.bincount(cell, g, 64).reshape(8, 8), np.bincount(cell, h, 64).reshape(8, 8) + 0.5)
            table += step
            total += step.ravel()[cell]
    return model


def _measure(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and x, the features of column t."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            x = features(*text_bytes(b.column(b.schema.names.index("t"))))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.names.index(c)) for c in keep], lists], [*keep, "x"])

    return rows.mapInArrow(run, rows.select(*keep).schema.add("x", T.ArrayType(T.DoubleType())))


def train(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, key: str = "doc_id", text: str = "text", sample: int = 20_000) -> Gam:
    """A model of ``label`` (0 or 1) from ``sample`` rows of ``labels`` at most, of those ``allowed`` (an expression over ``labels``)."""
    ship(docs.sparkSession)
    pick = labels.where(allowed & F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
    pick = pick.orderBy(F.xxhash64("k"), "k", "y").limit(sample)
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).join(F.broadcast(pick), "k")
    got = _measure(rows, ["k", "y"]).orderBy(F.xxhash64("k"), "k", "y").limit(sample).toPandas()
    return fit(np.array(got.x.tolist(), float).reshape(-1, len(FEATURES)), got.y.to_numpy())


def score(docs: DataFrame, model: Gam, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, score) for every row."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(known.value.score(features(*text_bytes(b.column(1)))), pa.float64())], ["k", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(run, f"k {kind}, score double").withColumnRenamed("k", key)


def keep(docs: DataFrame, model: Gam, least: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            x = features(*text_bytes(b.column(names.index(text))))
            yield b.filter(pa.array(known.value.score(x) >= least))

    return docs.mapInArrow(run, docs.schema)
