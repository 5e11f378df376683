"""Properties of features, models, scores and the elbow."""

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from patronage import schema as S
from patronage.operators import clustering as C
from patronage.operators.elbow import elbow_pick, elbow_ratios, reductions
from patronage.operators.features import scale, unscaled_count
from patronage.operators.measures import rfm
from patronage.sources import tables


@pytest.fixture(scope="module")
def customers(spark, small):
    return rfm(tables.invoices(spark, small))


@pytest.fixture(scope="module")
def clustering(customers):
    return C.cluster(customers, 4)


def _points(df):
    columns = (vector_to_array("features").alias("x"), "prediction")
    return [(r.x, r.prediction) for r in df.select(*columns).collect()]


def _squared(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def _brute_silhouette(points):
    """Mean over points of the squared-distance silhouette, all pairs compared."""
    groups = {}
    for x, label in points:
        groups.setdefault(label, []).append(x)
    total = 0.0
    for x, label in points:
        own = groups[label]
        if len(own) == 1:
            continue
        a = sum(_squared(x, y) for y in own) / (len(own) - 1)
        b = min(
            sum(_squared(x, y) for y in other) / len(other)
            for name, other in groups.items()
            if name != label
        )
        total += (b - a) / max(a, b)
    return total / len(points)


def test_null_measures_are_left_out_and_counted(spark):
    df = spark.createDataFrame(
        [(1, 5, 1, 10.0), (2, None, 2, 20.0), (3, 9, 3, 60.0)],
        "CustomerID bigint, Recency int, Frequency bigint, Monetary double",
    )
    features, _ = scale(df)
    values = features.select("CustomerID", vector_to_array("features").alias("x"))
    rows = {r.CustomerID: r.x for r in values.collect()}
    assert set(rows) == {1, 3}
    assert rows[1] == pytest.approx([-math.sqrt(0.5)] * 3)
    assert unscaled_count(df).first()[0] == 1


def test_kmeans_labels_are_nearest_centres(clustering):
    model = clustering.kmeans_model
    points = _points(model.transform(clustering.features))
    centres = model.clusterCenters()
    cost = 0.0
    for x, label in points:
        distances = [_squared(x, c) for c in centres]
        assert label == distances.index(min(distances))
        cost += min(distances)
    assert model.summary.trainingCost == pytest.approx(cost, rel=1e-6)


def test_mixture_labels_are_most_probable(clustering):
    rows = clustering.gmm_model.transform(clustering.features).select(
        vector_to_array("probability").alias("p"), "prediction"
    )
    for r in rows.collect():
        assert sum(r.p) == pytest.approx(1.0)
        assert r.p[r.prediction] == max(r.p)


def test_scores_equal_brute_force(clustering):
    for df, score in (
        (clustering.kmeans, clustering.kmeans_score),
        (clustering.gmm, clustering.gmm_score),
    ):
        assert score == pytest.approx(_brute_silhouette(_points(df)), rel=1e-6)


def test_score_table_and_choice(clustering):
    rows = {r.model: r for r in clustering.scores().collect()}
    assert rows[S.KMEANS_NAME].silhouette == clustering.kmeans_score
    assert [name for name, r in rows.items() if r.chosen] == [clustering.best_model]
    best = clustering.kmeans if clustering.best_model == S.KMEANS_NAME else clustering.gmm
    assert clustering.best_predictions is best
    assert clustering.best_score == max(clustering.kmeans_score, clustering.gmm_score)


@pytest.mark.parametrize(
    "kmeans, gmm, chosen",
    [
        (0.5, 0.4, S.KMEANS_NAME),
        (0.4, 0.5, S.MIXTURE_NAME),
        (0.5, 0.5, S.MIXTURE_NAME),
        (0.5, None, S.KMEANS_NAME),
        (None, -0.5, S.MIXTURE_NAME),
        (None, None, S.MIXTURE_NAME),
    ],
)
def test_model_choice(kmeans, gmm, chosen):
    assert C.choose_model(kmeans, gmm) == chosen


def test_numbers_follow_money(clustering):
    for df in (clustering.kmeans, clustering.gmm):
        means = df.groupBy("prediction").agg(F.avg("Monetary").alias("m")).orderBy("prediction")
        values = [r.m for r in means.collect()]
        assert values == sorted(values, reverse=True)
        assert [r.prediction for r in means.collect()] == list(range(len(values)))


def test_labels_are_renumbered_by_broadcast(clustering):
    plan = clustering.kmeans._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_numbers_survive_a_change_of_model_numbers(clustering):
    labelled = clustering.kmeans_model.transform(clustering.features)
    turned = labelled.withColumn("prediction", (F.col("prediction") + 1) % 4)
    both = [
        C.renumber(df, C.canonical_numbers(df)).select("CustomerID", "prediction")
        for df in (labelled, turned)
    ]
    assert both[0].exceptAll(both[1]).count() == 0


def test_fewer_points_than_clusters(spark):
    df = spark.createDataFrame(
        [(i, 10 * (i % 2), 1 + i % 2, 100.0 * (i % 2)) for i in range(6)],
        "CustomerID bigint, Recency int, Frequency bigint, Monetary double",
    )
    labelled = C.label(df, C.fit_kmeans, 4)
    assert labelled.select("prediction").distinct().count() == 2


def test_one_cluster_has_no_silhouette(customers):
    features, _ = scale(customers)
    assert C.silhouette(features.withColumn("prediction", F.lit(0))) is None


def test_member_on_its_own_counts_zero(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 1.0), (2, 2, 1, 1.0), (3, 90, 9, 90.0)],
        "CustomerID bigint, Recency int, Frequency bigint, Monetary double",
    )
    features, _ = scale(df)
    labelled = features.withColumn("prediction", (F.col("CustomerID") == 3).cast("int"))
    assert C.silhouette(labelled) == pytest.approx(_brute_silhouette(_points(labelled)))


def test_cost_sweep(customers):
    features, _ = scale(customers)
    rows = C.cost_sweep(features, 5).collect()
    assert [r.k for r in rows] == [2, 3, 4, 5]
    assert all(r.WSSSE > 0 for r in rows)
    again = C.cost_sweep(features, 5, parallelism=1).collect()
    assert [r.WSSSE for r in again] == pytest.approx([r.WSSSE for r in rows])


def _curve(spark, *costs):
    rows = [(k, float(c)) for k, c in enumerate(costs, 2)]
    return spark.createDataFrame(rows, C.CURVE_SCHEMA)


def test_elbow_of_a_plain_curve(spark):
    curve = _curve(spark, 100, 60, 30, 25, 24)
    assert [r.Reduction for r in reductions(curve).orderBy("k").collect()] == [
        0.0,
        40.0,
        50.0,
        16.67,
        4.0,
    ]
    ratios = {r.k: r.ratio for r in elbow_ratios(curve).collect()}
    assert ratios == pytest.approx({3: 40 / 30, 4: 6.0, 5: 5.0})
    assert elbow_pick(curve).first().optimal_k == 4


def test_elbow_of_a_curve_with_flat_parts(spark):
    curve = _curve(spark, 5, 3, 3, 3, 2)
    assert {r.k: r.ratio for r in elbow_ratios(curve).collect()} == {3: None, 4: None, 5: 0.0}
    assert elbow_pick(curve).first().optimal_k == 5


def test_elbow_ties_take_the_smallest(spark):
    assert elbow_pick(_curve(spark, 16, 8, 4, 2, 1)).first().optimal_k == 3


def test_short_curves_have_no_elbow(spark):
    assert elbow_pick(_curve(spark, 5, 3)).count() == 0
    assert [r.Reduction for r in reductions(_curve(spark, 5)).collect()] == [0.0]
