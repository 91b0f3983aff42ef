"""Checks of fitted models by plain aggregates: what must hold if a model is what it says.

Each check takes the model's own output, counts what is wrong with it, and finds nothing for a right model.
"""

from __future__ import annotations

from functools import reduce
from math import log
from operator import add

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLOSE = 1e-9  # of recomputed sums of the same numbers


def apart(a: Column, b: Column, tolerance: float = CLOSE) -> Column:
    """The two differ, or one is missing; relative to their size."""
    scale = F.greatest(F.abs(a), F.abs(b), F.lit(1.0))
    return F.coalesce(F.abs(a - b) > tolerance * scale, F.lit(True))


def rmse_of(scored: DataFrame, label: str) -> float:
    return scored.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col(label), 2)))).first()[0]


def r2_of(scored: DataFrame, label: str) -> float:
    error, spread = scored.agg(
        F.sum(F.pow(F.col("prediction") - F.col(label), 2)), F.var_pop(label) * F.count(label)
    ).first()
    return 1 - error / spread


def accuracy_of(scored: DataFrame, label: str) -> float:
    return scored.agg(F.avg((F.col("prediction") == F.col(label)).cast("int"))).first()[0]


def close(a: float, b: float, tolerance: float = CLOSE) -> bool:
    return abs(a - b) <= tolerance * max(abs(a), abs(b), 1.0)


def wrong_leaf_means(train: DataFrame, label: str) -> int:
    """Leaves of a regression tree, told apart by their value, whose value is not the mean of their training rows."""
    leaves = train.groupBy("prediction").agg(F.avg(label).alias("mean"))
    return leaves.where(apart(F.col("prediction"), F.col("mean"))).count()


def unknown_values(scored: DataFrame, train: DataFrame) -> int:
    """Rows with a prediction that no training row has."""
    known = train.select("prediction").distinct()
    return scored.select("prediction").join(known, "prediction", "left_anti").count()


def wrong_leaf_shares(train: DataFrame, label: str, classes: int) -> int:
    """Leaves of a classification tree, told apart by their probabilities, whose probabilities are not the shares of
    the classes among their training rows, or whose prediction is not the most frequent class."""
    leaves = train.groupBy(vector_to_array("probability").alias("p"), "prediction").agg(
        F.array(*(F.avg((F.col(label) == k).cast("double")) for k in range(classes))).alias("shares")
    )
    differs = F.exists(F.zip_with("p", "shares", lambda a, b: apart(a, b)), lambda x: x)
    chosen = F.get("shares", F.col("prediction").cast("int"))
    return leaves.where(differs | F.coalesce(chosen < F.array_max("shares"), F.lit(True))).count()


def tree_sums(model: Model, scored: DataFrame, column: str = "prediction") -> DataFrame:
    """`scored` with _sum: the weighted sum of what the model's trees say, one after another."""
    terms = []
    for i, (tree, weight) in enumerate(zip(model.trees, model.treeWeights, strict=True)):
        name = f"_tree{i}"
        tree = tree.copy()
        unused = [p for p in ("predictionCol", "probabilityCol", "rawPredictionCol") if tree.hasParam(p)]
        for param in unused:
            tree = tree._set(**{param: f"{name}_{param}"})
        scored = tree.transform(scored)
        said = scored[f"{name}_{column}Col"]
        terms.append((vector_to_array(said)[1] if column == "probability" else said) * float(weight))
    return scored.withColumn("_sum", reduce(add, terms))


def wrong_sums(model: Model, scored: DataFrame, mean: bool) -> int:
    """Predictions that are not the sum (or mean) of the model's trees."""
    total = F.col("_sum") / len(model.trees) if mean else F.col("_sum")
    return tree_sums(model, scored).where(apart(F.col("prediction"), total)).count()


def wrong_signs(model: Model, scored: DataFrame) -> int:
    """Two-class predictions that differ from the sign of the sum of the model's trees."""
    said = F.col("prediction") == (F.col("_sum") > 0).cast("double")
    return tree_sums(model, scored).where(~F.coalesce(said, F.lit(False))).count()


def wrong_votes(model: Model, scored: DataFrame) -> int:
    """Rows of a forest whose probability of class 1 is not the mean of its trees'."""
    own = vector_to_array("probability")[1]
    return tree_sums(model, scored, "probability").where(apart(own, F.col("_sum") / len(model.trees))).count()


def slopes(rows: DataFrame, error: Column, inputs: int) -> tuple[list[float], list[float]]:
    """Mean products of an error with each standardised feature, and the features' deviations; the last slope is
    that of the intercept."""
    x = vector_to_array("features")
    values = rows.select(error.alias("_e"), *(x[i].alias(f"_x{i}") for i in range(inputs)))
    found = values.agg(
        F.avg("_e").alias("e"),
        *(F.covar_pop("_e", f"_x{i}").alias(f"c{i}") for i in range(inputs)),
        *(F.stddev_samp(f"_x{i}").alias(f"s{i}") for i in range(inputs)),
    ).first()
    spread = [found[f"s{i}"] or 0.0 for i in range(inputs)]
    return [found[f"c{i}"] / s if s else 0.0 for i, s in enumerate(spread)] + [found["e"]], spread


def wrong_elastic_net(rows: DataFrame, weights: list[float], intercept: float, penalty: float, mix: float) -> int:
    """Conditions of the penalised least squares that the weights violate: for each weight, the slope of the loss
    at it lies within the pull of the penalty, and the mean error is 0. `rows` has features and label."""
    fitted = dot(vector_to_array("features"), weights) + float(intercept)
    slope, spread = slopes(rows, fitted - F.col("label"), len(weights))
    deviation = rows.agg(F.stddev_samp("label")).first()[0]
    penalty = penalty / deviation
    wrong = int(abs(slope[-1]) > 1e-6 * deviation)
    for g, w, s in zip(slope, weights, spread, strict=False):
        pull = penalty * (1 - mix) * w * s / deviation
        wrong += int(abs(g / deviation + pull) > penalty * mix + 1e-3)
    return wrong


def wrong_logistic(train: DataFrame, label: str, inputs: int) -> int:
    """Slopes of the log loss that are not 0 at the fitted weights."""
    error = vector_to_array("probability")[1] - F.col(label)
    return sum(abs(slope) > 1e-3 for slope in slopes(train, error, inputs)[0])


def wrong_logits(scored: DataFrame, weights: list[float], intercept: float) -> int:
    """Rows whose probability is not the logistic curve of the weighted features, or whose prediction is not its
    larger side."""
    logit = dot(vector_to_array("features"), weights) + float(intercept)
    share = vector_to_array("probability")[1]
    side = F.col("prediction") == (share > 0.5).cast("double")
    return scored.where(apart(share, 1 / (1 + F.exp(-logit))) | ~side).count()


def dot(values: Column, weights: list[float]) -> Column:
    """Sum of an array's values times their weights."""
    products = F.zip_with(values, F.array(*(F.lit(float(w)) for w in weights)), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, product: total + product)


def distance(values: Column, centre: list[float]) -> Column:
    """Squared distance of an array from a point."""
    gaps = F.zip_with(values, F.array(*map(F.lit, map(float, centre))), lambda a, b: (a - b) * (a - b))
    return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)


def misplaced(clustered: DataFrame, centres: list[list[float]]) -> int:
    """Rows nearer to another centre than to their own."""
    all_distances = F.array(*(distance(vector_to_array("features"), list(c)) for c in centres))
    rows = clustered.select("prediction", all_distances.alias("d"))
    own = F.get("d", F.col("prediction").cast("int"))
    return rows.where(F.coalesce(own > F.array_min("d") * (1 + CLOSE), F.lit(True))).count()


def moved_centres(clustered: DataFrame, centres: list[list[float]], converged: bool) -> int:
    """Centres that are not the means of their members.

    A search that has come to rest moves centres by a thousandth of the rows' distance from them at most if it is run
    on; one that was stopped before by a quarter.
    """
    rows = clustered.select(F.col("prediction").cast("int").alias("k"), vector_to_array("features").alias("v"))
    own = F.get(F.array(*(F.array(*map(F.lit, map(float, c))) for c in centres)), F.col("k"))
    gaps = F.zip_with("v", own, lambda a, b: a - b)
    square = F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g * g)
    spread = rows.select("k", gaps.alias("g"), square.alias("q")).groupBy("k").agg(
        F.sqrt(F.avg("q")).alias("radius"), *(F.avg(F.col("g")[i]).alias(f"g{i}") for i in range(len(centres[0])))
    )
    most, wrong = 1e-3 if converged else 0.25, 0
    for row in spread.collect():  # one row a cluster
        shift = sum(row[f"g{i}"] ** 2 for i in range(len(centres[0]))) ** 0.5
        wrong += shift > most * max(row["radius"], CLOSE)
    return wrong


def costs_more_than_drawn(clustered: DataFrame, centres: list[list[float]], key: str) -> bool:
    """The rows are not nearer to the centres, in squares, than to as many different rows that a hash of the key draws."""
    drawn = clustered.groupBy(vector_to_array("features").alias("v")).agg(F.min(F.xxhash64(key)).alias("h"))
    start = [list(r["v"]) for r in drawn.orderBy("h").limit(len(centres)).collect()]
    values = vector_to_array("features")
    nearest = lambda points: F.array_min(F.array(*(distance(values, p) for p in points)))
    own, first = clustered.agg(F.sum(nearest(centres)), F.sum(nearest(start))).first()
    return own > first * (1 + CLOSE)


def wrong_first_step(train: DataFrame, label: str, weights: list[float], intercept: float, penalty: float, mix: float) -> int:
    """Weights, or the intercept, that are not where the first step of a search for the least penalised log loss leads.

    It starts at weights 0 and the logarithm of the odds of the label. With features scaled by their deviation, it goes
    against the slope of the loss there, shortened by the pull of the penalty on absolute weights. Its factor is half
    the inverse of the slope's length, or comes from that by trials: a tenth, or 2.1 times, of the one before.
    """
    rows = train.select("features", F.col(label).cast("double").alias("_y"))
    share = rows.agg(F.avg("_y")).first()[0]
    if not share or share == 1:
        return sum(map(bool, weights))
    slope, spread = slopes(rows, F.lit(share) - F.col("_y"), len(weights))
    pull = penalty * mix
    way = [g + pull if g < -pull else g - pull if g > pull else 0.0 for g in slope[:-1]]
    scaled = [w * s for w, s in zip(weights, spread, strict=True)]
    if not any(way):
        return sum(map(bool, scaled))
    factor = -sum(w * g for w, g in zip(scaled, way, strict=True)) / sum(g * g for g in way)
    start = 0.5 / sum(g * g for g in slope[:-1]) ** 0.5
    wrong = int(not any(close(factor / (start * 0.1**a * 2.1**b), 1.0, 1e-6) for a in range(8) for b in range(8)))
    largest = max(map(abs, way))
    wrong += sum(abs(w + factor * g) > 1e-6 * abs(factor) * largest for w, g in zip(scaled, way, strict=True))
    means = rows.select(vector_to_array("features").alias("v")).agg(*(F.avg(F.col("v")[i]) for i in range(len(weights)))).first()
    centred = intercept + sum(w * m for w, m in zip(weights, means, strict=True))
    return wrong + int(not close(centred, log(share / (1 - share)), 1e-6))


def silhouette_of(clustered: DataFrame) -> float:
    """Mean silhouette by squared distance, from the number, sum and square sum of each cluster."""
    rows = clustered.select(F.col("prediction").cast("int").alias("k"), vector_to_array("features").alias("v"))
    width = len(rows.first()["v"])
    square = F.aggregate("v", F.lit(0.0), lambda total, a: total + a * a)
    moments = rows.withColumn("q", square).groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.sum("q").alias("q"), *(F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(width))
    )
    terms, n = {}, {}
    for m in moments.collect():  # one row a cluster
        mean = [float(m[f"s{i}"]) / m["n"] for i in range(width)]
        terms[m["k"]], n[m["k"]] = square + float(m["q"]) / m["n"] - 2 * dot(F.col("v"), mean), m["n"]
    own, other = F.lit(None).cast("double"), F.lit(None).cast("double")
    for k, term in terms.items():
        rest = [t for j, t in terms.items() if j != k]
        inside = term * n[k] / (n[k] - 1) if n[k] > 1 else F.lit(None).cast("double")
        own = F.when(F.col("k") == k, inside).otherwise(own)
        other = F.when(F.col("k") == k, F.least(*rest) if len(rest) > 1 else rest[0]).otherwise(other)
    score = F.when(own.isNull(), 0.0).otherwise((other - own) / F.greatest(own, other))
    return rows.agg(F.avg(score)).first()[0]
