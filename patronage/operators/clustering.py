"""K-Means and Gaussian mixture models, their silhouettes and the choice between them."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import copy_context
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import (
    GaussianMixture,
    GaussianMixtureModel,
    KMeans,
    KMeansModel,
)
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronage import schema as S
from patronage.operators.features import scale
from patronage.operators.profile import mean
from patronage.staging import stage

CURVE_SCHEMA = "k int, WSSSE double"
Fit = Callable[[DataFrame, int], KMeansModel | GaussianMixtureModel]
SCORE_SCHEMA = "model string, silhouette double, chosen boolean"


@dataclass(frozen=True)
class Clustering:
    """Both models' labelled customers, their scores and which model won."""

    kmeans: DataFrame
    gmm: DataFrame
    kmeans_score: float | None
    gmm_score: float | None
    kmeans_model: KMeansModel
    gmm_model: GaussianMixtureModel
    scaler: PipelineModel
    features: DataFrame

    @property
    def best_model(self) -> str:
        return choose_model(self.kmeans_score, self.gmm_score)

    @property
    def best_score(self) -> float | None:
        return self.kmeans_score if self.best_model == S.KMEANS_NAME else self.gmm_score

    @property
    def best_predictions(self) -> DataFrame:
        return self.kmeans if self.best_model == S.KMEANS_NAME else self.gmm

    def scores(self) -> DataFrame:
        """One row per model."""
        rows = [
            (S.KMEANS_NAME, self.kmeans_score, self.best_model == S.KMEANS_NAME),
            (S.MIXTURE_NAME, self.gmm_score, self.best_model == S.MIXTURE_NAME),
        ]
        return self.features.sparkSession.createDataFrame(rows, SCORE_SCHEMA)


def choose_model(kmeans_score: float | None, gmm_score: float | None) -> str:
    """K-Means only when strictly better; a tie goes to the mixture model.

    A missing score, from a model that found a single cluster, loses to any other.
    """
    if kmeans_score is not None and (gmm_score is None or kmeans_score > gmm_score):
        return S.KMEANS_NAME
    return S.MIXTURE_NAME


def silhouette(
    labelled: DataFrame, label: str = "prediction", *, clusters: int | None = None
) -> float | None:
    """Mean silhouette by squared Euclidean distance; None with fewer than two clusters.

    The evaluator sums per cluster and broadcasts one row per cluster, so no pair of
    customers is ever compared. A caller that knows the number of `clusters` saves a pass.
    """
    if clusters is None:
        clusters = labelled.select(label).distinct().limit(2).count()
    if clusters < 2:
        return None
    return ClusteringEvaluator(
        predictionCol=label,
        featuresCol="features",
        metricName="silhouette",
        distanceMeasure="squaredEuclidean",
    ).evaluate(labelled)


#: Customers that a partition of a fit holds.
FIT_ROWS = 250_000


def dealt(rows: DataFrame, *, id_column: str = "CustomerID", fit_rows: int = FIT_ROWS) -> DataFrame:
    """The same rows in an order and in partitions that depend only on their ids and number.

    Models start from samples that are drawn partition by partition, so without this the same
    customers give other clusters when a table is written in other pieces.
    """
    partitions = max(1, -(-rows.count() // fit_rows))
    return rows.repartition(partitions, id_column).sortWithinPartitions(id_column)


def fit_kmeans(features: DataFrame, k: int) -> KMeansModel:
    return KMeans(
        featuresCol="features", k=k, seed=S.SEED, maxIter=S.KMEANS_ITERATIONS, tol=S.TOLERANCE
    ).fit(features)


def fit_mixture(features: DataFrame, k: int) -> GaussianMixtureModel:
    return GaussianMixture(
        featuresCol="features", k=k, seed=S.SEED, maxIter=S.MIXTURE_ITERATIONS, tol=S.TOLERANCE
    ).fit(features)


def canonical_numbers(labelled: DataFrame) -> DataFrame:
    """Rows (prediction, number) that number clusters by falling mean Monetary, then rising mean Recency.

    A model's own numbers depend on the seed and on how rows are partitioned.
    """
    means = labelled.groupBy("prediction").agg(
        mean("Monetary").alias("monetary"), F.avg("Recency").alias("recency")
    )
    # One row per cluster, so the window is as small as k.
    order = Window.orderBy(F.desc("monetary"), "recency", "prediction")
    return stage(
        means.select("prediction", (F.row_number().over(order) - 1).alias("number")), "numbers"
    )


def renumber(labelled: DataFrame, numbers: DataFrame | None) -> DataFrame:
    """Replace a model's own cluster numbers; `None` leaves them."""
    if numbers is None:
        return labelled
    joined = labelled.join(numbers, "prediction").withColumn("prediction", F.col("number"))
    return joined.select(*labelled.columns)


def label(rfm: DataFrame, fit: Fit, k: int = 4) -> DataFrame:
    """Scale the measures, fit one model and label the customers with canonical numbers."""
    features, scaler = scale(dealt(rfm))
    labelled = stage(fit(features, k).transform(scaler.transform(rfm)), "labels")
    return renumber(labelled, canonical_numbers(labelled))


def _in_threads(spark: SparkSession, tasks: list[Callable], parallelism: int) -> list:
    """Run independent fits side by side, so the gaps of one are filled by another."""
    here = [copy_context() for _ in tasks]
    run = inheritable_thread_target(spark)(lambda job: job[0].run(job[1]))
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        return pool.map(run, list(zip(here, tasks)))


def cluster(rfm: DataFrame, k: int = 4, *, canonical: bool = True) -> Clustering:
    """Scale the measures, fit both models side by side, score both.

    Each model is applied once: its labels are staged, and scores, numbers and everything later
    read them. Each fit keeps its own vectors cached while it iterates. `canonical=False` keeps
    the models' own cluster numbers.
    """
    if not rfm.limit(1).count():
        raise ValueError("no customers to cluster")
    dealt_features, scaler = scale(dealt(rfm))
    features = scaler.transform(rfm)

    def run(fit: Fit):
        model = fit(dealt_features, k)
        labelled = stage(model.transform(features), "labels")
        numbers = canonical_numbers(labelled)
        score = silhouette(labelled, clusters=numbers.count())
        return model, score, renumber(labelled, numbers if canonical else None)

    (kmeans_model, kmeans_score, kmeans), (gmm_model, gmm_score, gmm) = _in_threads(
        rfm.sparkSession, [lambda: run(fit_kmeans), lambda: run(fit_mixture)], 2
    )
    return Clustering(
        kmeans=kmeans,
        gmm=gmm,
        kmeans_score=kmeans_score,
        gmm_score=gmm_score,
        kmeans_model=kmeans_model,
        gmm_model=gmm_model,
        scaler=scaler,
        features=features,
    )


def sweep_models(features: DataFrame, max_k: int = 10, *, parallelism: int = 2) -> dict[int, KMeansModel]:
    """K-Means for k = 2..max_k.

    All fits iterate over one persisted frame of vectors, which spills to disk where memory is
    short and is given up at the end; `parallelism` is how many fits share it at a time.
    """
    vectors = dealt(features).select("features").persist(StorageLevel.MEMORY_AND_DISK)

    def fit(k: int) -> tuple[int, KMeansModel]:
        return k, KMeans(featuresCol="features", k=k, seed=S.SEED, maxIter=S.SWEEP_ITERATIONS).fit(vectors)

    try:
        # The largest k takes longest, so it starts first.
        tasks = [lambda k=k: fit(k) for k in range(max_k, 1, -1)]
        return dict(sorted(_in_threads(features.sparkSession, tasks, parallelism), key=lambda found: found[0]))
    finally:
        vectors.unpersist(blocking=True)


def cost_sweep(features: DataFrame, max_k: int = 10, *, parallelism: int = 2) -> DataFrame:
    """Within-cluster sum of squares of K-Means for k = 2..max_k, ordered by k."""
    models = sweep_models(features, max_k, parallelism=parallelism)
    rows = [(k, float(model.summary.trainingCost)) for k, model in models.items()]
    return features.sparkSession.createDataFrame(rows, CURVE_SCHEMA)
