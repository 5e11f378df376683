"""What a fitted model says, worked out anew from its parameters by array functions alone.

A model's parameters become small tables. Every customer meets them as one scalar array, so a
check is one pass over the customers with one aggregate, however many models it covers.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.clustering import GaussianMixtureModel, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a mixture adds to each weighted density before it divides by their sum.
DENSITY_FLOOR = float(np.finfo(float).eps)


def centre_table(spark: SparkSession, models: dict[int, KMeansModel]) -> DataFrame:
    """(k, prediction, centre): the centres of one model for each k."""
    rows = [(k, i, c.tolist()) for k, model in models.items() for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "k int, prediction int, centre array<double>")


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, d: s + d)


def distances(features: DataFrame, centres: DataFrame) -> DataFrame:
    """`features` with `distances`: an array of (k, distance, prediction), each k's nearest centre.

    The centres of all models come as one array: k and the number of models bound it.
    """
    per_k = centres.groupBy("k").agg(F.collect_list(F.struct("prediction", "centre")).alias("centres"))
    models = per_k.agg(F.array_sort(F.collect_list(F.struct("k", "centres"))).alias("models"))
    values = vector_to_array("features")
    nearest = lambda model: F.array_min(
        F.transform(
            model["centres"], lambda c: F.struct(squared_distance(F.col("x"), c["centre"]).alias("distance"), c["prediction"].alias("prediction"))
        )
    )
    found = features.withColumn("x", values).withColumn("models", models.scalar())
    return found.withColumn(
        "distances",
        F.transform(
            "models", lambda m: F.struct(m["k"].alias("k"), nearest(m)["distance"].alias("distance"), nearest(m)["prediction"].alias("prediction"))
        ),
    ).drop("x", "models")


def costs(features: DataFrame, centres: DataFrame) -> DataFrame:
    """(k, cost, customers): the sum of squares about the nearest centres, of all k in one pass."""
    each = distances(features, centres).select(F.inline("distances"))
    return each.groupBy("k").agg(F.sum("distance").alias("cost"), F.count("*").alias("customers"))


def kmeans_check(labelled: DataFrame, model: KMeansModel, tolerance: float = 1e-9) -> DataFrame:
    """One row: customers, those who are not at their nearest centre, and whether the cost differs.

    `labelled` has the model's own labels. Of two centres equally near, within `tolerance`, either
    will do. The cost is compared with what the evaluator's squared distances add up to.
    """
    spark = labelled.sparkSession
    centres = centre_table(spark, {model.getK(): model})
    own = centres.select("prediction", F.col("centre").alias("own_centre"))
    # One row per cluster.
    rows = distances(labelled, centres).join(F.broadcast(own), "prediction")
    own_distance = squared_distance(vector_to_array("features"), F.col("own_centre"))
    nearest = F.col("distances")[0]["distance"]
    found = rows.select(own_distance.alias("own"), nearest.alias("nearest")).agg(
        F.count("*").alias("customers"),
        F.count_if(F.col("own") > F.col("nearest") + tolerance).alias("not_nearest"),
        F.sum("nearest").alias("cost"),
    )
    expected = float(model.summary.trainingCost)
    # the trained cost is that of the last step, before the centres moved once more
    differs = (F.col("cost") > expected * (1 + 1e-9)) | (F.col("cost") < expected * 0.99)
    return found.select("customers", "not_nearest", differs.cast("long").alias("cost_differing"))


def _density_table(spark: SparkSession, model: GaussianMixtureModel) -> DataFrame:
    """(prediction, mean, inverse, log_scale): what the weighted density of each component needs."""
    rows = []
    for i, (weight, r) in enumerate(zip(model.weights, model.gaussiansDF.collect())):
        covariance = r["cov"].toArray()
        sign, logdet = np.linalg.slogdet(covariance)
        scale = math.log(weight) - 0.5 * (len(covariance) * math.log(2 * math.pi) + logdet)
        rows.append((i, r["mean"].toArray().tolist(), np.linalg.inv(covariance).tolist(), float(scale)))
    return spark.createDataFrame(rows, "prediction int, mean array<double>, inverse array<array<double>>, log_scale double")


def memberships(features: DataFrame, model: GaussianMixtureModel) -> DataFrame:
    """`features` with `memberships`: each component's share in a customer, from its parameters."""
    table = _density_table(features.sparkSession, model)
    parts = table.agg(F.array_sort(F.collect_list(F.struct("prediction", "mean", "inverse", "log_scale"))).alias("parts"))

    def density(c: Column) -> Column:
        off = F.zip_with(F.col("x"), c["mean"], lambda x, m: x - m)
        dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
        return F.lit(DENSITY_FLOOR) + F.exp(c["log_scale"] - dot(off, F.transform(c["inverse"], lambda row: dot(row, off))) / 2)

    found = features.withColumn("x", vector_to_array("features")).withColumn("parts", parts.scalar())
    found = found.withColumn("densities", F.transform("parts", density))
    total = F.aggregate("densities", F.lit(0.0), lambda s, d: s + d)
    return found.withColumn("memberships", F.transform("densities", lambda d: d / total)).drop("x", "parts", "densities")


def mixture_check(labelled: DataFrame, model: GaussianMixtureModel, tolerance: float = 1e-6, moved: float = 0.05) -> DataFrame:
    """One row: customers whose shares do not add up to one or who are not where their share is
    largest, and components that one more step would move by more than `moved` standard deviations.

    `labelled` has the model's own labels and probabilities.
    """
    rows = memberships(labelled, model).withColumn("p", vector_to_array("probability"))
    total = F.aggregate("p", F.lit(0.0), lambda s, v: s + v)
    counted = rows.agg(
        F.count_if(F.abs(total - 1) > tolerance).alias("sums_off"),
        F.count_if(F.col("memberships")[F.col("prediction")] < F.array_max("memberships") - tolerance).alias("not_most_probable"),
    )
    shares = rows.select(
        vector_to_array("features").alias("x"), F.posexplode("memberships").alias("prediction", "share")
    ).select("prediction", "share", F.posexplode("x").alias("dimension", "value"))
    stepped = shares.groupBy("prediction", "dimension").agg((F.sum(F.col("share") * F.col("value")) / F.sum("share")).alias("stepped"))
    means = _density_table(labelled.sparkSession, model).select("prediction", F.posexplode("mean").alias("dimension", "mean"))
    # One row per component and dimension.
    off = means.join(F.broadcast(stepped), ["prediction", "dimension"], "left")
    still = off.groupBy("prediction").agg(F.max(F.abs(F.col("stepped") - F.col("mean"))).alias("off"))
    steps = still.agg(F.count_if(F.col("off").isNull() | (F.col("off") > moved)).alias("means_moved"))
    return counted.withColumn("means_moved", steps.scalar())
