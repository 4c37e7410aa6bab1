"""Quality score by a generalised additive model with pairwise interactions.

Each feature of a text falls into one of a few bins. Boosting goes round the features in
turn: a shallow tree over the bins of one feature is fitted to what the model still gets
wrong, and its leaf values, made small, are added to that feature's lookup table. Then the
pairs of features whose joint table explains most of the rest get tables of their own in the
same way. A score is the logistic of a sum of table entries, so it is computed by adding
looked-up vectors for a whole batch.

The fit sees a bounded sample of labelled rows (``SAMPLE``); features of every whole text
are computed in Spark. Labels, language, source and id are never inputs.

Edge cases: null and empty texts have all features 0 and get a score; a null or other label
than 0 and 1 is not used; several labels of one document count as 0 if any is 0; without
labels of both kinds every score is the share of label 1 (0.5 without any); repeated rows
get equal scores; very long texts are read whole; other columns are not read, or kept as they are when filtering.
"""

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import held_out, text_or_empty

#: Labelled documents used for the fit, the first in the order of a hash of their id.
SAMPLE = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 120
RATE = 0.15
THRESHOLD = 0.3

FEATURES = [
    "chars", "words", "lines", "word_length", "line_words", "upper", "digits", "punctuation", "symbols", "spaces",
    "distinct_words", "top_word", "repeated_pairs", "repeated_lines", "short_words", "long_words", "ends", "bars",
    "doubled_marks", "capitalised", "odd_lines", "worst_line",
]
SYMBOLS = regex.compile(r"[#$%&*@^~|<>{}\[\]\\_=+]")
MARKS = regex.compile(r"[^\w\s]{2,}")
PUNCTUATION = regex.compile(r"[.,;:!?'\"()-]")


def text_features(text: str) -> list[float]:
    """Plain statistics of one whole text, in the order of FEATURES."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    size, count = len(text), len(words)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    pairs = set(zip(words, words[1:]))
    letters = sum(map(len, words))
    upper = sum(map(str.isupper, words))
    symbols = len(SYMBOLS.findall(text))
    odd = [len(MARKS.findall(line)) / (1 + line.count(" ")) for line in lines]
    return [
        np.log1p(size),
        np.log1p(count),
        np.log1p(len(lines)),
        letters / count,
        np.log1p(count / max(len(lines), 1)),
        upper / count,
        sum(map(str.isdigit, words)) / count,
        len(PUNCTUATION.findall(text)) / count,
        symbols / count,
        (size - letters) / size,
        len(counts) / count**0.85,
        counts.most_common(1)[0][1] / count,
        1 - len(pairs) / max(count - 1, 1) if count > 1 else 0.0,
        1 - len(set(lines)) / max(len(lines), 1),
        sum(n for w, n in counts.items() if len(w) <= 3) / count,
        sum(n for w, n in counts.items() if len(w) >= 12) / count,
        (text.count(". ") + text.count(".\n")) / count,
        text.count("|") / count,
        sum(odd) / max(len(odd), 1),
        sum(n for w, n in counts.items() if w[0].isupper() and not w.isupper()) / count,
        sum(x > 0.3 for x in odd) / max(len(odd), 1),
        max(odd, default=0.0),
    ]


def features_of(text: Column) -> Column:
    """The features of whole texts as a column."""

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([text_features(t or "") for t in texts])

    return features(text)


@dataclass
class Model:
    """Bin edges and lookup tables; a few thousand numbers."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[
                np.searchsorted(self.pair_edges[a], x[:, a], side="right"),
                np.searchsorted(self.pair_edges[b], x[:, b], side="right"),
            ]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _split(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """The gain and place of the best cut of a run of bins."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = left_g**2 / (left_h + ridge) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + ridge)
    best = int(np.argmax(gain))
    return float(gain[best] - g.sum() ** 2 / (h.sum() + ridge)), best + 1


def _tree(g: np.ndarray, h: np.ndarray, ridge: float = 3.0, leaves: int = 4) -> np.ndarray:
    """Values of a tree of a few leaves over neighbouring bins."""
    runs = [(0, len(g))]
    while len(runs) < leaves:
        cuts = [(*_split(g[a:b], h[a:b], ridge), a, b) for a, b in runs]
        gain, at, a, b = max(cuts)
        if gain <= 1e-9:
            break
        runs.remove((a, b))
        runs += [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in runs:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of one axis followed by a cut of the other on each side; its gain and values."""
    best = (0.0, np.zeros(g.shape))
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        for cut in range(1, len(gg)):
            out = np.zeros(gg.shape)
            gain = 0.0
            for rows in (slice(0, cut), slice(cut, len(gg))):
                values = _tree(gg[rows].sum(axis=0), hh[rows].sum(axis=0), leaves=2)
                out[rows] = values
                gain += float(values @ gg[rows].sum(axis=0))
            if gain > best[0]:
                best = (gain, out.T if flip else out)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting on the driver; ``x`` has at most SAMPLE rows."""
    n_features = len(FEATURES)
    share = float(np.mean(y)) if len(y) else 0.5
    if not len(y) or share in (0, 1):
        share = min(max(share, 1e-3), 1 - 1e-3)
        flat, none = [np.zeros(1)] * n_features, [np.zeros(0)] * n_features
        return Model(float(np.log(share / (1 - share))), none, flat, none, [], [])
    edges = [_edges(x[:, j], BINS) for j in range(n_features)]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    intercept = float(np.log(share / (1 - share)))
    total = np.full(len(y), intercept)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for j in range(n_features):
            g, h = slopes()
            size = len(tables[j])
            step = RATE * _tree(np.bincount(bins[j], g, size), np.bincount(bins[j], h, size))
            tables[j] += step
            total += step[bins[j]]
    pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(n_features)]
    pair_bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(pair_edges)]

    def joint(a: int, b: int, values: np.ndarray) -> np.ndarray:
        shape = (len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)
        return np.bincount(pair_bins[a] * shape[1] + pair_bins[b], values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    gains = sorted(
        ((_pair_tree(joint(a, b, g), joint(a, b, h))[0], a, b) for a in range(n_features) for b in range(a)), reverse=True
    )
    pairs = [(a, b) for _, a, b in gains[:PAIRS]]
    pair_tables = [np.zeros((len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)) for a, b in pairs]
    for _ in range(ROUNDS // 6):
        for k, (a, b) in enumerate(pairs):
            g, h = slopes()
            step = RATE * _pair_tree(joint(a, b, g), joint(a, b, h))[1]
            pair_tables[k] += step
            total += step[pair_bins[a], pair_bins[b]]
    return Model(intercept, edges, tables, pair_edges, pairs, pair_tables)


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on at most SAMPLE labelled documents that are not held out."""
    marked = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    some = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = (
        some.select("doc_id", F.col("quality").cast("int").alias("quality"), features_of(F.col("text")).alias("features"))
        .groupBy("doc_id")
        .agg(F.min(F.struct("quality", "features")).alias("row"))
        .select("row.*")
        .collect()
    )
    x = np.array([r.features for r in rows], dtype=float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r.quality for r in rows], dtype=float))


def score_of(model: Model, text: Column) -> Column:
    """The score of whole texts as a column."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([text_features(t or "") for t in texts], dtype=float).reshape(-1, len(FEATURES))
        return pd.Series(model.score(x))

    return score(text)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    score = score_of(trained(docs, labels), F.col("text"))
    out = docs.select("doc_id", held_out().alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose predicted label is 1, with all their columns."""
    return docs.where(score_of(trained(docs, labels), F.col("text")) >= THRESHOLD)
