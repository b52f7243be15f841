"""Tree classifiers from Spark ML, trained on the executors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.resample import SEED
from tidemill.session import checkpoint_dir


def _fit(train: DataFrame, features: Sequence[str], label: str, classifier) -> PipelineModel:
    """Fit on a frame that is computed once; a lost part of it is computed again from its lineage.

    A training row with a null or NaN feature fails the fit: fill such features first.
    """
    checkpoint_dir(train.sparkSession)
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="error")
    held = train.select(*features, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = Pipeline(stages=[assembler, classifier]).fit(held)
    finally:
        held.unpersist()
    model.stages[0].setHandleInvalid("keep")  # `predict` keeps every row
    return model


def fit_boosted(train: DataFrame, features: Sequence[str], label: str, rounds: int = 20, depth: int = 5,
                step: float = 0.1, seed: int = SEED) -> PipelineModel:
    """Gradient-boosted trees. Node ids are checkpointed every ten rounds, so a lost executor costs ten at most."""
    return _fit(train, features, label, GBTClassifier(
        featuresCol="_features", labelCol=label, predictionCol="prediction", maxIter=rounds, maxDepth=depth,
        stepSize=step, seed=seed, checkpointInterval=10, cacheNodeIds=True))


def fit_tree(train: DataFrame, features: Sequence[str], label: str, depth: int = 10, seed: int = SEED) -> PipelineModel:
    """One decision tree."""
    return _fit(train, features, label, DecisionTreeClassifier(
        featuresCol="_features", labelCol=label, predictionCol="prediction", maxDepth=depth, seed=seed,
        checkpointInterval=10, cacheNodeIds=True))


def predict(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """Every row of the frame with a 0/1 `prediction`, null where a feature is null or NaN."""
    types = dict(frame.dtypes)
    features = model.stages[0].getInputCols()
    known = F.lit(True)
    for name in features:
        known = known & F.col(name).isNotNull()
        if types[name] in ("double", "float"):
            known = known & ~F.isnan(name)
    scored = model.transform(frame.withColumn("_known", known))
    return scored.select(*frame.columns, F.when(F.col("_known"), F.col("prediction").cast("int")).alias("prediction"))


@dataclass(frozen=True)
class TreeRules:
    """A fitted classifier as plain rules. A tree is a number (a leaf) or (feature, threshold, low side, high side).

    As a column the rules run inside generated code, and as SQL text in any engine, without the model at hand.
    """

    features: tuple[str, ...]
    trees: tuple
    weights: tuple[float, ...]
    boosted: bool

    def column(self) -> Column:
        """The 0/1 prediction of a row, null where a feature is null or NaN."""
        def rule(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(tree)
            feature, threshold, low, high = tree
            return F.when(F.col(self.features[feature]).cast("double") <= threshold, rule(low)).otherwise(rule(high))

        score = sum((rule(t) * F.lit(w) for t, w in zip(self.trees, self.weights, strict=True)), F.lit(0.0))
        known = F.lit(True)
        for name in self.features:
            known = known & F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))
        return F.when(known, F.when(score > 0, 1).otherwise(0) if self.boosted else score.cast("int"))

    def sql(self) -> str:
        """The same as a SQL expression over columns of the features' names."""
        def rule(tree) -> str:
            if not isinstance(tree, tuple):
                return f"CAST({tree!r} AS DOUBLE)"
            feature, threshold, low, high = tree
            return f'CASE WHEN CAST("{self.features[feature]}" AS DOUBLE) <= {threshold!r} THEN {rule(low)} ELSE {rule(high)} END'

        score = " + ".join(f"({rule(t)}) * {w!r}" for t, w in zip(self.trees, self.weights, strict=True))
        known = " AND ".join(f'"{f}" IS NOT NULL AND NOT isnan(CAST("{f}" AS DOUBLE))' for f in self.features)
        value = f"CASE WHEN {score} > 0 THEN 1 ELSE 0 END" if self.boosted else f"CAST({score} AS INT)"
        return f"CASE WHEN {known} THEN {value} END"


def tree_rules(model: PipelineModel) -> TreeRules:
    """The rules of `fit_boosted` or `fit_tree`; as many nodes as the depth and the number of trees allow."""
    fitted = model.stages[1]
    boosted = hasattr(fitted, "trees")

    def rules(node):
        if node.getClass().getSimpleName() == "LeafNode":
            return float(node.prediction())
        split = node.split()
        return (int(split.featureIndex()), float(split.threshold()), rules(node.leftChild()), rules(node.rightChild()))

    trees = fitted.trees if boosted else [fitted]
    weights = tuple(float(w) for w in fitted.treeWeights) if boosted else (1.0,)
    return TreeRules(tuple(model.stages[0].getInputCols()), tuple(rules(t._call_java("rootNode")) for t in trees), weights, boosted)
