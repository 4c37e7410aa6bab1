"""Feature attributions of linear and tree models."""

from dataclasses import dataclass
from math import factorial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.models.predictors import TreePredictor

#: Rows that are explained at once, and numbers of an intermediate array.
ROWS_AT_ONCE, CELLS = 512, 2_000_000
#: Bytes of leaves that are sent to every executor, at most: some 1.5 million leaves of depth 6.
MOST_BYTES = 300_000_000
#: Rows of a background sample, at most.
BACKGROUND = 100


def linear_attributions(df: DataFrame, coefficients: dict[str, float], keys=("city", "timestamp")) -> DataFrame:
    """Long attributions of a linear model against the mean of ``df`` itself.

    The mean is one row by construction, so joining it moves no data rows.
    """
    names = list(coefficients)
    means = df.agg(*[F.avg(F.col(n).cast("double")).alias(f"_mean_{n}") for n in names])
    entries = [
        F.struct(
            F.lit(n).alias("feature"),
            (F.lit(float(coefficients[n])) * (F.col(n).cast("double") - F.col(f"_mean_{n}"))).alias("phi"),
        )
        for n in names
    ]
    return df.join(F.broadcast(means)).select(*keys, F.inline(F.array(*entries)))


def linear_importance(df: DataFrame, coefficients: dict[str, float], by=()) -> DataFrame:
    """Mean absolute attribution per feature."""
    return mean_absolute(linear_attributions(df, coefficients, [*by]), by)


def mean_absolute(attributions: DataFrame, by=()) -> DataFrame:
    return attributions.groupBy(*by, "feature").agg(F.avg(F.abs("phi")).alias("importance"))


def tree_attributions(df: DataFrame, predictor: TreePredictor, keys=("city", "timestamp")) -> DataFrame:
    """Path-dependent Shapley values of a tree ensemble, one array per row.

    Returns the keys, ``base`` (the expected prediction), ``prediction`` and
    ``phi`` in the order of ``predictor.features``; base plus the sum of phi is
    the prediction. Rows are independent, so nothing is shuffled. Every executor holds the
    model's leaves, whose size is checked.
    """
    base, leaves = leaf_groups(predictor)
    size = sum(group.bytes for group in leaves)
    if size > MOST_BYTES:
        raise ValueError(f"the leaves of the model take {size} bytes, more than the {MOST_BYTES} that executors get")

    def explained(predictor, leaves, matrix):
        phi = np.zeros_like(matrix)
        for group in leaves:
            group.add_to(phi, matrix)
        return base, predictor.predict(matrix), phi

    return _explained(df, predictor.features, keys, (predictor, leaves), explained)


def _explained(df: DataFrame, features, keys, model, explained) -> DataFrame:
    """Keys, ``base``, ``prediction`` and ``phi`` from a function of the model's parts and a matrix."""
    inputs = [F.col(n).cast("double").alias(f"_x{i}") for i, n in enumerate(features)]
    schema = T.StructType([df.schema[k] for k in keys])
    schema = schema.add("base", "double").add("prediction", "double").add("phi", T.ArrayType(T.DoubleType()))
    sent = df.sparkSession.sparkContext.broadcast(model)
    keys = list(keys)

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), ROWS_AT_ONCE):
                rows = batch.iloc[start : start + ROWS_AT_ONCE]
                out = rows[keys].copy()
                matrix = np.ascontiguousarray(rows[[f"_x{i}" for i in range(len(features))]].to_numpy(dtype=float))
                out["base"], out["prediction"], phi = explained(*sent.value, matrix)
                out["phi"] = list(phi)
                yield out

    return df.select(*keys, *inputs).mapInPandas(run, schema)


def interventional_attributions(
    df: DataFrame, predictor, background: DataFrame, keys=("city", "timestamp"), most: int = BACKGROUND, seed: int = 42
) -> DataFrame:
    """Shapley values of any model against a background sample, one array per row.

    A feature that is not known takes the value of a background row. For each background
    row the features become known one by one, in a random order and in its reverse, and each
    gets what the prediction changes by. So base (the mean prediction of the background)
    plus the sum of phi is the prediction exactly; a model that adds up its features gets
    its exact values, any other the mean over the orders drawn. ``background`` has the
    model's features and at most ``most`` rows, all of which go to every executor.
    """
    names = list(predictor.features)
    sample = background.select([F.col(n).cast("double").alias(n) for n in names]).limit(most + 1).toPandas().to_numpy(dtype=float)
    if not 0 < len(sample) <= most:
        raise ValueError(f"the background needs 1 to {most} rows")
    rng = np.random.default_rng(seed)
    orders = [rng.permutation(len(names)) for _ in sample]
    base = float(predictor.predict(sample).mean())

    def explained(predictor, sample, orders, matrix):
        phi = np.zeros_like(matrix)
        for known, order in zip(sample, orders):
            for one in (order, order[::-1]):
                mixed = np.tile(known, (len(matrix), 1))
                before = predictor.predict(mixed)
                for feature in one:
                    mixed[:, feature] = matrix[:, feature]
                    after = predictor.predict(mixed)
                    phi[:, feature] += after - before
                    before = after
        return base, predictor.predict(matrix), phi / (2 * len(sample))

    return _explained(df, names, keys, (predictor, sample, orders), explained)


def tree_importance(attributed: DataFrame, features, by=()) -> DataFrame:
    """Mean absolute attribution per feature without exploding rows first."""
    means = [F.avg(F.abs(F.col("phi")[i])).alias(f"_m{i}") for i in range(len(features))]
    entries = [F.struct(F.lit(n).alias("feature"), F.col(f"_m{i}").alias("importance")) for i, n in enumerate(features)]
    return attributed.groupBy(*by).agg(*means).select(*by, F.inline(F.array(*entries)))


def to_long(attributed: DataFrame, features, keys=("city", "timestamp")) -> DataFrame:
    names = F.array(*[F.lit(n) for n in features])
    return attributed.select(*keys, F.posexplode("phi").alias("_i", "phi")).select(
        *keys, F.get(names, F.col("_i")).alias("feature"), "phi"
    )


@dataclass(frozen=True)
class LeafGroup:
    """Leaves with the same number of features on their paths, as flat arrays.

    A leaf is reached through an interval per feature on its path. With a feature known,
    the row is inside its interval or not; with it unknown, the ``share`` of training rows
    that took the path's branches counts. Each array has a row per leaf and a column per
    feature; ``amount`` is what the leaf adds to a prediction.
    """

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    amount: np.ndarray

    @property
    def bytes(self) -> int:
        return sum(a.nbytes for a in (self.features, self.low, self.high, self.share, self.amount))

    def add_to(self, phi: np.ndarray, matrix: np.ndarray) -> None:
        """Add the Shapley values of these leaves for the rows of a matrix."""
        depth = self.features.shape[1]
        step = max(1, CELLS // (len(matrix) * (depth + 1)))
        for start in range(0, len(self.features), step):
            of = slice(start, start + step)
            features, amount = self.features[of], self.amount[of]
            values = matrix[:, features]  # rows x leaves x depth
            inside = ((values > self.low[of]) & (values <= self.high[of])).astype(float)
            gains = shapley_values(inside, np.broadcast_to(self.share[of], inside.shape)) * amount[:, None]
            flat = features.ravel()
            order = np.argsort(flat, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(flat[order]) > 0])
            phi[:, flat[order][starts]] += np.add.reduceat(gains.reshape(len(matrix), -1)[:, order], starts, axis=1)


def leaf_groups(predictor: TreePredictor) -> tuple[float, list[LeafGroup]]:
    """The expected prediction, and all leaves by the number of features on their paths."""
    base, by_depth = 0.0, {}
    for t, weight in enumerate(predictor.weights):
        stack = [(0, {})]
        while stack:
            node, path = stack.pop()
            left, right = predictor.left[t, node], predictor.right[t, node]
            if left < 0:
                amount = weight * predictor.value[t, node]
                base += amount * np.prod([s for _, _, s in path.values()])
                if path:
                    by_depth.setdefault(len(path), []).append((path, amount))
                continue
            feature, cut = predictor.feature[t, node], predictor.threshold[t, node]
            low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
            for child, bounds in ((left, (low, min(high, cut))), (right, (max(low, cut), high))):
                taken = predictor.count[t, child] / predictor.count[t, node]
                stack.append((child, {**path, feature: (*bounds, share * taken)}))
    groups = []
    for depth, leaves in sorted(by_depth.items()):
        edges = np.array([[p for p in path.values()] for path, _ in leaves]).reshape(len(leaves), depth, 3)
        features = np.array([list(path) for path, _ in leaves])
        groups.append(LeafGroup(features, *(np.ascontiguousarray(edges[:, :, k]) for k in range(3)), np.array([a for _, a in leaves])))
    return base, groups


def shapley_values(inside: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Shapley values of product games whose players are the last axis.

    A set of players is worth the product of ``inside`` over the set and of ``share`` over
    all others. The products summed over the sets of one size are the coefficients of the
    product of (share + inside x) over the players; without one player they are built from
    those of the players before and after it.
    """
    d = inside.shape[-1]
    chance = [factorial(k) * factorial(d - 1 - k) / factorial(d) for k in range(d)]

    def times(polynomial, j):
        out = np.zeros((*polynomial.shape[:-1], polynomial.shape[-1] + 1))
        out[..., :-1] = polynomial * share[..., j, None]
        out[..., 1:] += polynomial * inside[..., j, None]
        return out

    after = [np.empty(0)] * (d + 1)
    one = np.ones((*inside.shape[:-1], 1))
    values = np.empty(inside.shape)
    before = [one]
    for j in range(d - 1):
        before.append(times(before[-1], j))
    after[d] = one
    for j in range(d - 1, 0, -1):
        after[j] = times(after[j + 1], j)
    for i in range(d):
        total = 0.0
        for a in range(i + 1):
            for b in range(d - i):
                total = total + before[i][..., a] * after[i + 1][..., b] * chance[a + b]
        values[..., i] = (inside[..., i] - share[..., i]) * total
    return values
