"""A pairwise model that is fitted: logistic regression with monotone features, searched over its penalties.

Spark's own optimiser does the fitting, distributed over the pairs. Missing features are a value of their own: the mean
goes in their place, and a column tells that they were missing. A feature's sign can be held, so that the score never
falls (or never rises) with it. What is fitted is an expression over the feature columns, so scoring stays in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.entities import GROUPS, columns_of

# The signs that features are held to, by group, in feature order.
SIGNS = {
    "name_similarity": (1, 1, 1, 0, 0, 0),
    "affiliation_similarity": (0,),
    "email_similarity": (1, 1),
    "coauthor_similarity": (1, 0, 1),
    "venue_similarity": (0,),
    "year_diff": (-1,),
    "title_similarity": (1, 1),
    "reference_features": (1, 1, 1, 1, 1, 1),
    "misc_features": (0, 0, 0, 0, 0),
    "name_counts": (0, -1, -1, -1, 0, -1),
    "embedding_similarity": (0,),
    "journal_similarity": (0,),
    "advanced_name_similarity": (0, 0, 0, 0),
}
PENALTIES = tuple((reg, mix) for reg in (1e-4, 1e-3, 1e-2, 1e-1) for mix in (0.0,))


def signs_of(groups: list[str] | None = None) -> dict[str, int]:
    """Signs by feature column, of all groups or some."""
    return {c: s for g in GROUPS if groups is None or g in groups for c, s in zip(columns_of([g]), SIGNS[g])}


@dataclass(frozen=True)
class PairwiseModel:
    """weights: (mean, weight, weight of being missing) by feature column."""

    weights: dict[str, tuple[float, float, float]]
    bias: float
    penalty: tuple[float, float]
    auroc: float | None

    def probability(self) -> Column:
        """P(same person) over the feature columns."""
        z = F.lit(self.bias)
        for name, (mean, w, missing) in sorted(self.weights.items()):
            z = z + F.when(F.col(name).isNull() | F.isnan(name), missing).otherwise((F.col(name) - mean) * w)
        return 1 / (1 + F.exp(-z))

    def distance(self) -> Column:
        return 1 - self.probability()


def fit(train: DataFrame, features: list[str], label: str = "label", signs: dict[str, int] | None = None, val: DataFrame | None = None, penalties: tuple[tuple[float, float], ...] = PENALTIES) -> PairwiseModel:
    """The model of pairs (features..., label 0 or 1) with the penalty (strength, share of L1) that ranks val best (the first one without val).

    signs: 1 for features that may only speak for one person, -1 for those that may only speak against it. Ties go to the first penalty."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.linalg import Matrices

    from millrace.operators.metrics import ranking

    signs = signs or {}
    value = lambda c: F.when(F.isnan(c), None).otherwise(F.col(c).cast("double"))
    rows = train.where(F.col(label).isin(0, 1))
    stats = rows.agg(F.count("*").alias("_n"), *(x for i, c in enumerate(features) for x in (F.coalesce(F.avg(value(c)), F.lit(0.0)).alias(f"_m{i}"), F.coalesce(F.stddev(value(c)), F.lit(0.0)).alias(f"_s{i}"), F.count(value(c)).alias(f"_c{i}")))).first()
    means = {c: float(stats[f"_m{i}"]) for i, c in enumerate(features)}
    # columns that do not vary have no weight
    own = [c for i, c in enumerate(features) if stats[f"_s{i}"] > 0]
    gaps = [c for i, c in enumerate(features) if 0 < stats[f"_c{i}"] < stats["_n"]]
    parts = [F.coalesce(value(c) - means[c], F.lit(0.0)) for c in own] + [value(c).isNull().cast("double") for c in gaps]
    if not parts:
        raise ValueError("no feature varies")
    rows = rows.select(array_to_vector(F.array(*parts)).alias("x"), F.col(label).cast("double").alias("y"))
    n, big = len(parts), float("inf")
    low = [0.0 if signs.get(c) == 1 else -big for c in own] + [-big] * len(gaps)
    high = [0.0 if signs.get(c) == -1 else big for c in own] + [big] * len(gaps)
    best = None
    for reg, mix in penalties if val is not None else penalties[:1]:
        model = LogisticRegression(featuresCol="x", labelCol="y", regParam=reg, elasticNetParam=mix, maxIter=100)
        if any(signs.get(c) for c in own):
            model = model.setLowerBoundsOnCoefficients(Matrices.dense(1, n, low)).setUpperBoundsOnCoefficients(Matrices.dense(1, n, high))
        found = model.fit(rows)
        w = [float(v) for v in found.coefficients]
        at, of_gap = dict(zip(own, w)), dict(zip(gaps, w[len(own) :]))
        made = PairwiseModel({c: (means[c], at.get(c, 0.0), of_gap.get(c, 0.0)) for c in features}, float(found.intercept), (reg, mix), None)
        if val is None:
            return made
        scored = val.where(F.col(label).isin(0, 1)).select(F.col(label).cast("int").alias("label"), F.round(made.probability(), 6).alias("score"))
        auroc = ranking(scored).first()["auroc"]
        if best is None or (auroc or 0) > (best.auroc or 0):
            best = PairwiseModel(made.weights, made.bias, made.penalty, auroc)
    return best


def feature_shares(scored: DataFrame, model: PairwiseModel, key: list[str]) -> DataFrame:
    """(key..., feature, share): what each feature adds to a pair's log-odds beside the mean pair's, which for a linear model is its Shapley value."""
    each = [F.struct(F.lit(c).alias("feature"), F.when(F.col(c).isNull() | F.isnan(c), m).otherwise((F.col(c) - mean) * w).alias("share")) for c, (mean, w, m) in sorted(model.weights.items())]
    return scored.select(*key, F.explode(F.array(*each)).alias("s")).select(*key, "s.feature", "s.share")
