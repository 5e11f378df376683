"""Feature vectors for clustering: assembled measures, standardised."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage import schema as S


def scale(
    rfm: DataFrame, inputs: Sequence[str] = S.MEASURES
) -> tuple[DataFrame, PipelineModel]:
    """Add `features`, the inputs at mean 0 and sample standard deviation 1.

    A customer with a null measure has no place in feature space and is left out; see
    `unscaled_count`.
    """
    pipeline = Pipeline(
        stages=[
            VectorAssembler(
                inputCols=list(inputs), outputCol="features_vec", handleInvalid="skip"
            ),
            StandardScaler(
                inputCol="features_vec", outputCol="features", withMean=True, withStd=True
            ),
        ]
    )
    model = pipeline.fit(rfm)
    return model.transform(rfm), model


def unscaled_count(rfm: DataFrame, inputs: Sequence[str] = S.MEASURES) -> DataFrame:
    """How many customers `scale` leaves out, as one row."""
    missing = " OR ".join(f"`{name}` IS NULL" for name in inputs)
    return rfm.agg(F.count_if(F.expr(missing)).alias("unscaled_count"))
