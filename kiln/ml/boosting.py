"""Boosted regression trees fitted on the cells of their bins.

A tree sees of a row only the bin of each feature, and with squared errors the
gain of a split and the value of a leaf need only the number and the sum of the
labels on its sides. So rows that share all their bins can be one row, with
their mean as label and their number as weight: every round finds the same
splits, and the rows are read three times instead of seven times a round. There
are at most as many cells as the product of the bins, however many rows.

The bins are those that Spark's own fit of the rows would use, and its fit of
the cells grows the trees. The variances in the nodes are between cells only.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.session import scratch_path, scratch_scope
from kiln.sources import fs

#: Cells from which the square of Spark's ``maxBins`` no longer fits an integer.
MOST_CELLS = 46340 ** 2


class CellGBTRegressor(GBTRegressor):
    """``GBTRegressor`` that fits cells where they are fewer than the rows and
    say as much; elsewhere (weights, validation rows, sampled rows or features,
    absolute errors, least rows a node, categories) it is Spark's own."""

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        cuts = self._cuts(dataset) if self._cells_say_as_much() else None
        return super()._fit(dataset) if cuts is None else self._fit_cells(dataset, cuts)

    def _cells_say_as_much(self) -> bool:
        def given(p):
            return self.isDefined(p) and bool(self.getOrDefault(p))
        return (not given(self.weightCol) and not given(self.validationIndicatorCol)
                and self.getLossType().lower() == "squared" and self.getSubsamplingRate() == 1.0
                and self.getFeatureSubsetStrategy().lower() in ("auto", "all")
                and self.getMinInstancesPerNode() == 1)

    def _cuts(self, dataset: DataFrame) -> list[list[float]] | None:
        """Thresholds of every feature, found by Spark as at the start of its
        own fit: the same rows, sample and checks. None where a feature has
        categories or the bins allow as many cells as there are rows."""
        jvm = dataset.sparkSession.sparkContext._jvm

        def scala(name):
            return getattr(getattr(jvm, f"org.apache.spark.{name}$"), "MODULE$")

        self._transfer_params_to_java()
        java, frame = self._java_obj, dataset._jdf
        arity = scala("ml.util.MetadataUtils").getCategoricalFeatures(frame.schema().apply(self.getFeaturesCol()))
        if not arity.isEmpty():
            return None
        regression = scala("mllib.tree.configuration.Algo").Regression()
        strategy = java.getOldBoostingStrategy(arity, regression).treeStrategy()
        rows = scala("ml.util.DatasetUtils").extractInstances(java, frame, jvm.scala.Option.empty())
        about = scala("ml.tree.impl.DecisionTreeMetadata").buildMetadata(rows, strategy, 1, self.getFeatureSubsetStrategy())
        found = scala("ml.tree.impl.RandomForest").findSplits(rows, about, self.getSeed())
        cuts = [sorted({s.threshold() for s in of}) for of in found]
        return cuts if math.prod(len(c) + 1 for c in cuts) < min(about.numExamples(), MOST_CELLS) else None

    def _fit_cells(self, dataset: DataFrame, cuts: list[list[float]]) -> GBTRegressionModel:
        spark = dataset.sparkSession
        names = [f"_b{i}" for i in range(len(cuts))]
        with scratch_scope(spark):
            path = scratch_path(spark, "cells")
            binned = dataset.select(vector_to_array(F.col(self.getFeaturesCol())).alias("_x"), F.col(self.getLabelCol()).cast("double").alias("_y"))
            binned = binned.select("_y", *[F.col("_x")[i].alias(n) if c else F.lit(1.0).alias(n) for i, (n, c) in enumerate(zip(names, cuts))])
            cut = [(n, c) for n, c in zip(names, cuts) if c]
            if cut:     # a value equal to its threshold is below it
                binned = Bucketizer(inputCols=[n for n, _ in cut], outputCols=[f"{n}_" for n, _ in cut], splitsArray=[
                    [-math.inf, *[math.nextafter(t, math.inf) for t in c], math.inf] for _, c in cut]).transform(binned)
            (binned.select("_y", *[(F.col(f"{n}_") + 1 if c else F.col(n)).alias(n) for n, c in zip(names, cuts)])
             .groupBy(*names).agg(F.avg("_y").alias("_y"), F.count(F.lit(1)).cast("double").alias("_n")).write.parquet(path))
            cells = spark.read.parquet(path)
            # Bins are numbered from 1, as Spark guesses how many zeros a sample left out. It takes every
            # cell, not a sample, up to the square of maxBins, and then cuts between all bins that there are.
            few = cells.select(array_to_vector(F.array(*names)).alias(self.getFeaturesCol()),
                               F.col("_y").alias(self.getLabelCol()), "_n")
            most = math.prod(len(c) + 1 for c in cuts)
            on_cells = self.copy({self.weightCol: "_n", self.maxBins: max(self.getMaxBins(), math.isqrt(most) + 1)}).fit(few)
            there = cells.agg(*[F.sort_array(F.collect_set(n)).alias(n) for n in names]).first()      # bounded by the bins
            model = _with_cuts(spark, on_cells, [(i, (a + b) / 2, cuts[i][int(a) - 1]) for i, n in enumerate(names)
                                                 for a, b in zip(there[n], there[n][1:])])
        model.clear(model.weightCol)
        return self._copyValues(model)


def _with_cuts(spark, model: GBTRegressionModel, cuts) -> GBTRegressionModel:
    """The model with other thresholds: (feature, old, new)."""
    path, moved = scratch_path(spark, "trees"), scratch_path(spark, "trees")
    model.save(path)
    nodes = spark.read.parquet(f"{path}/data")
    split = F.col("nodeData.split")
    was = split["leftCategoriesOrThreshold"]
    met = nodes.join(F.broadcast(spark.createDataFrame(cuts, "_f int, _old double, _new double")),
                     (split["featureIndex"] == F.col("_f")) & (F.get(was, F.lit(0)) == F.col("_old")), "left")
    now = F.col("nodeData").withField("split.leftCategoriesOrThreshold", F.when(split["featureIndex"] < 0, was).otherwise(F.array("_new")))
    met.select(*[now.alias(c) if c == "nodeData" else c for c in nodes.columns]).write.parquet(moved)
    fs.delete(spark, f"{path}/data")
    fs.rename(spark, moved, f"{path}/data")
    return GBTRegressionModel.load(path)
