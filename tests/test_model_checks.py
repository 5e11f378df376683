"""The checks of models notice models that are wrong."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from patronage.operators import measures as M
from patronage.operators import model_checks
from patronage.operators.clustering import dealt, fit_kmeans, fit_mixture, label, sweep_models
from patronage.operators.features import scale
from patronage.sources import tables
from patronage.staging import stage


@pytest.fixture(scope="module")
def rfm(spark, small):
    return M.rfm(tables.invoices(spark, small))


@pytest.fixture(scope="module")
def features(rfm):
    return stage(scale(dealt(rfm))[0], "features")


def test_kmeans(features):
    model = fit_kmeans(features, 3)
    labelled = model.transform(features)
    found = model_checks.kmeans_check(labelled, model).first()
    assert tuple(found) == (features.count(), 0, 0)
    shifted = labelled.withColumn("prediction", (F.col("prediction") + 1) % 3)
    assert model_checks.kmeans_check(shifted, model).first().not_nearest > 0
    stretched = labelled.withColumn("features", F.col("features")).where("CustomerID % 2 = 0")
    assert model_checks.kmeans_check(stretched, model).first().cost_differing == 1


def test_distances_against_numpy(features, spark):
    models = sweep_models(features.select("CustomerID", "features"), 4)
    points = np.array([r[0] for r in features.select(vector_to_array("features")).collect()])
    found = {r.k: r.cost for r in model_checks.costs(features, model_checks.centre_table(spark, models)).collect()}
    assert sorted(found) == [2, 3, 4]
    for k, model in models.items():
        centres = np.array(model.clusterCenters())
        cost = ((points[:, None] - centres) ** 2).sum(2).min(1).sum()
        assert found[k] == pytest.approx(cost, rel=1e-12)


def test_mixture(features):
    model = fit_mixture(features, 3)
    labelled = stage(model.transform(features), "labels")
    assert tuple(model_checks.mixture_check(labelled, model).first()) == (0, 0, 0)
    for r in model_checks.memberships(labelled, model).limit(50).collect():
        assert r.memberships == pytest.approx(r.probability.toArray().tolist(), abs=1e-6)
    shifted = labelled.withColumn("prediction", (F.col("prediction") + 1) % 3)
    assert model_checks.mixture_check(shifted, model).first().not_most_probable > 0
    # other customers than the model was made for pull its means away
    other = labelled.where(vector_to_array("features")[0] > 0.5)
    assert model_checks.mixture_check(other, model).first().means_moved > 0


@pytest.mark.parametrize("fit", [fit_kmeans, fit_mixture])
def test_partitioning_changes_no_label(rfm, fit):
    results = []
    for table in (rfm.repartition(2, "Frequency"), rfm.repartition(9, "Recency"), rfm.orderBy(F.desc("Monetary")).coalesce(1)):
        results.append(sorted((r.CustomerID, r.prediction) for r in label(table, fit, 3).collect()))
    assert results[0] == results[1] == results[2]


def test_dealt_rows(rfm):
    table = dealt(rfm, fit_rows=40)
    assert table.rdd.getNumPartitions() == 4
    assert table.count() == rfm.count()
    assert dealt(rfm.limit(0)).count() == 0
