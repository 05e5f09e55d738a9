"""Stored models as column expressions: scoring stays in generated code and in the plan of its query or micro-batch.

The scaler is folded into every feature, a tree becomes nested conditions, centres become distances.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import MinMaxScalerModel, StandardScalerModel, VectorAssembler
from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled(stage, columns: list[Column]) -> list[Column]:
    """The scaled features."""
    if isinstance(stage, StandardScalerModel):
        means = stage.mean if stage.getWithMean() else [0.0] * len(columns)
        factors = [1 / s if s else 0.0 for s in stage.std] if stage.getWithStd() else [1.0] * len(columns)
        return [(c - F.lit(float(m))) * F.lit(float(f)) for c, m, f in zip(columns, means, factors)]
    if isinstance(stage, MinMaxScalerModel):
        low, high = stage.getMin(), stage.getMax()
        out = []
        for c, a, b in zip(columns, stage.originalMin, stage.originalMax):
            spread = float(b) - float(a)
            out.append((c - F.lit(float(a))) / F.lit(spread) * F.lit(high - low) + F.lit(low) if spread else F.when(c.isNotNull(), F.lit((high + low) / 2)))
        return out
    raise TypeError(f"no expression for {type(stage).__name__}")


def tree(model: DecisionTreeClassificationModel, features: list[Column]) -> Column:
    """Class of a tree; it has no more nodes than its depth allows."""

    def of(node) -> Column:
        if node.getClass().getSimpleName() == "LeafNode":
            return F.lit(float(node.prediction()))
        split = node.split()
        if split.getClass().getSimpleName() != "ContinuousSplit":
            raise TypeError("only splits of numbers are written as expressions")
        return F.when(features[split.featureIndex()] <= F.lit(float(split.threshold())), of(node.leftChild())).otherwise(of(node.rightChild()))

    known = features[0].isNotNull()
    for f in features[1:]:
        known = known & f.isNotNull()
    return F.when(known, of(model._java_obj.rootNode()))


def nearest(model: KMeansModel, features: list[Column]) -> Column:
    """Number of the nearest centre, the first of equally near ones."""
    distances = [sum(((f - F.lit(float(x))) * (f - F.lit(float(x))) for f, x in zip(features, centre)), F.lit(0.0)) for centre in model.clusterCenters()]
    least = F.least(*distances) if len(distances) > 1 else distances[0]
    out = F.when(distances[0] == least, 0)
    for n, d in enumerate(distances[1:], 1):
        out = out.when(d == least, n)
    return out


def prediction(model: PipelineModel) -> Column:
    """What the pipeline predicts from its input columns: a class as double, a cluster as int; null if a feature is null."""
    features: list[Column] = []
    for stage in model.stages:
        if isinstance(stage, VectorAssembler):
            features = [F.col(f"`{c}`").cast("double") for c in stage.getInputCols()]
        elif isinstance(stage, DecisionTreeClassificationModel):
            return tree(stage, features)
        elif isinstance(stage, KMeansModel):
            return nearest(stage, features)
        else:
            features = scaled(stage, features)
    raise TypeError("the pipeline ends without a model")
