"""Quality classifier: a generalised additive model with pairwise interactions.

Texts become a dozen and a half ratios, each put into quantile bins. Cyclic boosting goes round the
features; a step fits a tree of up to three leaves to one feature's residuals and adds it, shrunken, to
that feature's lookup table. Then the pairs whose coarse grids explain most of what is left get
tables of their own, boosted the same way with trees of up to four leaves. Scoring adds up one table entry per
feature and pair, for a batch of texts at a time.

The model is fitted on the driver from at most about ``most`` labelled rows, of which only the ratios are collected.

Edge cases: null and empty texts have all ratios 0 and are scored like any text; null ids and labels are
left out of fitting; without rows of both classes the score is a smoothed prior; repeated rows are scored
one by one; an empty table gives an empty result; further columns are kept.

Scale: one pass over the texts to score and one, over the labelled ones, to fit; no text is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import small_batches
from kerbside.llm.labels import remainder, training_rows

PARTS, HELD_OUT, CUT = 4, 2, 0.7
FEATURES = ["words", "word_length", "line_words", "distinct", "commonest", "repeated_lines", "repeated_pairs", "symbols", "pipes", "digits",
            "uppers", "blanks", "stops", "exclaims", "other_ascii", "beyond_ascii", "longest_word"]


def _byte_classes() -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[[ord(c) for c in "#*$%&<>"]] = 1
    table[ord("|")] = 2
    table[ord("0"):ord("9") + 1] = 3
    table[ord("A"):ord("Z") + 1] = 4
    table[[32, *range(9, 14)]] = 5
    table[[ord(c) for c in ".,;:"]] = 6
    table[[ord("!"), ord("?")]] = 7
    table[[ord(c) for c in "\"'()+-/=@[\\]^_`{}~"]] = 8
    table[0xC0:] = 9
    return table


BYTE_CLASSES = _byte_classes()


def features_of(text: str | None) -> list[float]:
    if not text:
        return [0.0] * len(FEATURES)
    data = text.encode("utf-8", "surrogatepass")
    kinds = np.bincount(BYTE_CLASSES[np.frombuffer(data, np.uint8)], minlength=10)
    words, n = text.split(), max(1, len(text))
    if not words:
        return [0.0] * len(FEATURES)
    lines = [x for x in text.split("\n") if x.strip()]
    counts, pairs = Counter(words), len(set(zip(words, words[1:])))
    k = len(words)
    return [np.log1p(k), len(text) / k, np.log1p(k / max(1, len(lines))), len(counts) / k ** 0.8, counts.most_common(1)[0][1] / k,
            1 - len(set(lines)) / max(1, len(lines)), 1 - pairs / max(1, k - 1), kinds[1] / n, kinds[2] / n, kinds[3] / n,
            kinds[4] / n + sum(map(str.isupper, words)) / k, kinds[5] / n, kinds[6] / k, kinds[7] / k, kinds[8] / n, kinds[9] / n,
            np.log1p(max(map(len, counts)))]


@dataclass
class Gam:
    """Bin edges and tables: ``tables[f]`` by bin, ``grids[(f, g)]`` by coarse bins of both."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    start: float
    tables: list[np.ndarray] = field(default_factory=list)
    grids: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], side="right")]
        for (f, g), grid in self.grids.items():
            total += grid[np.searchsorted(self.coarse[f], x[:, f], side="right"), np.searchsorted(self.coarse[g], x[:, g], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _split(gradient: np.ndarray, weight: np.ndarray, least: float) -> tuple[float, int]:
    """Gain and place of the best cut of consecutive bins."""
    g, w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    all_g, all_w = gradient.sum(), weight.sum()
    fine = (w >= least) & (all_w - w >= least)
    if not fine.any():
        return 0.0, 0
    gain = np.where(fine, g ** 2 / np.maximum(w, 1e-9) + (all_g - g) ** 2 / np.maximum(all_w - w, 1e-9) - all_g ** 2 / max(all_w, 1e-9), 0)
    place = int(gain.argmax())
    return float(gain[place]), place + 1


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """Values by bin of a tree with up to ``leaves`` leaves."""
    parts = [(0, len(gradient))]
    while len(parts) < leaves:
        cuts = [(*_split(gradient[a:b], weight[a:b], least), a, b) for a, b in parts]
        gain, at, a, b = max(cuts)
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    values = np.zeros(len(gradient))
    for a, b in parts:
        values[a:b] = gradient[a:b].sum() / (weight[a:b].sum() + 1.0)
    return values


def _grid_tree(gradient: np.ndarray, weight: np.ndarray, least: float) -> np.ndarray:
    """A cut along one feature, then a cut of either part along the other; the best first cut of both orders."""
    best, values = -1.0, np.zeros_like(gradient)
    for turned in (False, True):
        g, w = (gradient.T, weight.T) if turned else (gradient, weight)
        for at in range(1, len(g)):
            trial, gain = np.zeros_like(g), 0.0
            for rows in (slice(0, at), slice(at, None)):
                leaf = _tree(g[rows].sum(0), w[rows].sum(0), 2, least)
                trial[rows] = leaf
                gain += (leaf * g[rows].sum(0)).sum()
            if gain > best:
                best, values = gain, trial.T if turned else trial
    return values


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 120, rate: float = 0.15, n_pairs: int = 6) -> Gam:
    """Cyclic boosting on the driver; ``x`` is bounded by the sample."""
    prior = (y.sum() + 1) / (len(y) + 2)
    cut = lambda f, n: np.unique(np.quantile(x[:, f], np.linspace(0, 1, n + 1)[1:-1])) if len(x) else np.empty(0)
    gam = Gam([cut(f, bins) for f in range(x.shape[1])], [cut(f, 8) for f in range(x.shape[1])], float(np.log(prior / (1 - prior))))
    gam.tables = [np.zeros(len(e) + 1) for e in gam.edges]
    if len(set(y.tolist())) < 2:
        return gam
    fine = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(gam.edges)]
    rough = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(gam.coarse)]
    total, least = np.full(len(y), gam.start), max(5.0, len(y) / 2000)
    probability = lambda: 1 / (1 + np.exp(-total))
    for _ in range(rounds):
        for f, b in enumerate(fine):
            p = probability()
            size = len(gam.tables[f])
            step = rate * _tree(np.bincount(b, y - p, size), np.bincount(b, p * (1 - p) + 1e-6, size), 3, least * 0.02)
            gam.tables[f] += step
            total += step[b]
    strength = {}
    p = probability()
    for f in range(x.shape[1]):
        for g in range(f):
            shape = (len(gam.coarse[f]) + 1, len(gam.coarse[g]) + 1)
            code, size = rough[f] * shape[1] + rough[g], shape[0] * shape[1]
            strength[f, g] = (np.bincount(code, y - p, size) ** 2 / (np.bincount(code, p * (1 - p), size) + 1.0)).sum()
    for pair in sorted(strength, key=strength.get)[::-1][:n_pairs]:
        gam.grids[pair] = np.zeros((len(gam.coarse[pair[0]]) + 1, len(gam.coarse[pair[1]]) + 1))
    for _ in range(rounds // 3):
        for (f, g), grid in gam.grids.items():
            p = probability()
            code = rough[f] * grid.shape[1] + rough[g]
            step = rate * _grid_tree(np.bincount(code, y - p, grid.size).reshape(grid.shape),
                                     np.bincount(code, p * (1 - p) + 1e-6, grid.size).reshape(grid.shape), least * 0.02)
            grid += step
            total += step.reshape(-1)[code]
    return gam


def learn(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> Gam:
    small_batches(docs.sparkSession)

    def ratios(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [features_of(t) for t in batch["text"]], "label": batch["label"]})

    rows = training_rows(docs, labels, "quality", PARTS, HELD_OUT, most)
    got = rows.mapInPandas(ratios, "x array<double>, label int").toPandas()  # bounded by ``most``
    x = np.array([*got["x"]], float).reshape(-1, len(FEATURES))
    y = got["label"].to_numpy(float)
    order = np.lexsort([*x.T, y])  # rows arrive in any order
    return fit(x[order], (y[order] > 0).astype(float))


def scored(docs: DataFrame, gam: Gam) -> DataFrame:
    """``docs`` with ``score`` between 0 and 1."""
    small_batches(docs.sparkSession)
    docs = docs.drop("score")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", score double"

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array([features_of(t) for t in batch["text"]], float).reshape(-1, len(FEATURES))
            yield batch.assign(score=gam.score(x))

    return docs.mapInPandas(score, schema)


def quality(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> DataFrame:
    """``docs`` with held_out, score and predicted, which replace columns of these names."""
    return scored(docs, learn(docs, labels, most)).withColumns({
        "held_out": remainder(F.col("doc_id"), PARTS) == HELD_OUT, "predicted": (F.col("score") >= CUT).cast("int")})
