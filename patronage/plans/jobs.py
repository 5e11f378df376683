"""The three analyses a user runs, and their export.

Every analysis reads the whole source once, to build the customer table, which is staged. Counting
what cleaning removes and the preview read it again when they are looked at. Charts start from the
staged tables and are computed when they are asked for.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from patronage import schema as S
from patronage.operators import charts, elbow, segments
from patronage.operators.cleaning import clean, cleaning_stats, preview
from patronage.operators.clustering import Clustering, cluster, cost_sweep
from patronage.operators.features import unscaled_count
from patronage.operators.measures import invoice_facts, rfm, snapshot_of
from patronage.operators.profile import customer_kpis, group_means, group_sizes, profile, scored
from patronage.operators.quartiles import quartiles
from patronage.sources.exports import (
    CUSTOMERS_NAME,
    REPORT_NAME,
    commit_export,
    write_report,
)
from patronage.staging import stage


class Charts(Mapping[str, DataFrame]):
    """Chart data by name; a chart's own passes run when it is first looked up."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers, self._made = dict(makers), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


# Pairs of measures that are laid against each other, and the third one.
MEASURE_PAIRS = {
    "rf": ("Recency", "Frequency", "Monetary"),
    "fm": ("Frequency", "Monetary", "Recency"),
    "rm": ("Recency", "Monetary", "Frequency"),
}


@dataclass(frozen=True)
class CustomerAnalysis:
    """Customers with their measures, quartiles and score, and summaries of them.

    `snapshot` is the date that recency counts back from.
    """

    cleaning: DataFrame
    preview: DataFrame
    customers: DataFrame
    kpis: DataFrame
    snapshot: DataFrame
    charts: Mapping[str, DataFrame]


@dataclass(frozen=True)
class ClusterAnalysis:
    """Customers with clusters and segments, and what is known about each cluster."""

    k: int
    clustering: Clustering
    segmented: DataFrame
    profile: DataFrame
    summary: DataFrame
    recommendations: DataFrame
    impact: DataFrame
    unscaled: DataFrame
    elbow: Mapping[str, DataFrame]
    charts: Mapping[str, DataFrame]


@dataclass(frozen=True)
class FullAnalysis:
    customers: CustomerAnalysis
    clusters: ClusterAnalysis


def _customer_table(
    lines: DataFrame,
    invoices: DataFrame | None,
    on_bad_date: str,
    as_of: datetime.date | None,
) -> DataFrame:
    facts = invoice_facts(clean(lines, on_bad_date=on_bad_date)) if invoices is None else invoices
    return quartiles(rfm(facts, as_of=as_of))


def _customer_analysis(
    lines: DataFrame,
    cleaning: DataFrame | None,
    first_rows: DataFrame | None,
    customers: DataFrame,
    on_bad_date: str,
) -> CustomerAnalysis:
    if cleaning is None:
        cleaning = cleaning_stats(lines, on_bad_date=on_bad_date)
    if first_rows is None:
        first_rows = preview(clean(lines, on_bad_date=on_bad_date), ordered=False)
    makers = {
        "hist_recency": lambda: charts.recency_histogram(customers),
        "hist_frequency": lambda: charts.frequency_histogram(customers),
        "hist_monetary": lambda: charts.monetary_histogram(customers),
    }
    for name, columns in MEASURE_PAIRS.items():
        makers[f"grid_{name}"] = lambda columns=columns: charts.grid(customers, *columns)
    return CustomerAnalysis(
        cleaning=cleaning,
        preview=first_rows,
        customers=customers,
        kpis=customer_kpis(customers),
        snapshot=snapshot_of(customers),
        charts=Charts(makers),
    )


def _cluster_analysis(
    customers: DataFrame, k: int, max_k: int | None, rules: S.SegmentRules
) -> ClusterAnalysis:
    clustering = cluster(customers, k)
    # The features' vectors are left behind: what follows reads one narrow table.
    labelled = stage(scored(clustering.best_predictions), "labelled")
    named = stage(segments.name_groups(profile(labelled), rules=rules), "named")
    makers = {
        "sizes": lambda: group_sizes(labelled),
        "means": lambda: group_means(labelled),
        "box_recency": lambda: charts.box_statistics(labelled, "Recency"),
        "box_monetary": lambda: charts.box_statistics(labelled, "Monetary"),
        "cube_by_cluster": lambda: charts.cube(labelled, key="prediction"),
    }
    for name, columns in MEASURE_PAIRS.items():
        makers[f"grid_{name}_by_cluster"] = lambda columns=columns: charts.grid(
            labelled, *columns, key="prediction"
        )
    curve = cost_sweep(clustering.features, max_k) if max_k else None
    return ClusterAnalysis(
        k=k,
        clustering=clustering,
        segmented=segments.attach_segments(labelled, named),
        profile=named.orderBy("prediction"),
        summary=segments.segment_summary(named),
        recommendations=segments.recommend(named),
        impact=segments.impact_summary(named),
        unscaled=unscaled_count(customers),
        elbow={}
        if curve is None
        else {"table": elbow.reductions(curve), "pick": elbow.elbow_pick(curve)},
        charts=Charts(makers),
    )


def rfm_only(
    lines: DataFrame,
    *,
    invoices: DataFrame | None = None,
    cleaning: DataFrame | None = None,
    first_rows: DataFrame | None = None,
    on_bad_date: str = "keep",
    as_of: datetime.date | None = None,
) -> CustomerAnalysis:
    """Clean the lines and describe the customers.

    A source that can sum or count its own lines, or give a few of them, more cheaply than this
    passes the results as `invoices`, `cleaning` and `first_rows`.
    """
    customers = _customer_table(lines, invoices, on_bad_date, as_of)
    return _customer_analysis(lines, cleaning, first_rows, customers, on_bad_date)


def clustering_only(
    lines: DataFrame,
    *,
    invoices: DataFrame | None = None,
    k: int = 4,
    max_k: int | None = 10,
    rules: S.SegmentRules = S.SegmentRules(),
    on_bad_date: str = "keep",
    as_of: datetime.date | None = None,
) -> ClusterAnalysis:
    """Cluster the customers without describing them first; `max_k=None` skips the sweep."""
    customers = _customer_table(lines, invoices, on_bad_date, as_of)
    return _cluster_analysis(customers, k, max_k, rules)


def full_analysis(
    lines: DataFrame,
    *,
    invoices: DataFrame | None = None,
    cleaning: DataFrame | None = None,
    first_rows: DataFrame | None = None,
    k: int = 4,
    max_k: int | None = 10,
    rules: S.SegmentRules = S.SegmentRules(),
    on_bad_date: str = "keep",
    as_of: datetime.date | None = None,
) -> FullAnalysis:
    """Describe the customers and cluster them, from one customer table."""
    customers = _customer_table(lines, invoices, on_bad_date, as_of)
    return FullAnalysis(
        customers=_customer_analysis(lines, cleaning, first_rows, customers, on_bad_date),
        clusters=_cluster_analysis(customers, k, max_k, rules),
    )


def export(
    analysis: ClusterAnalysis, folder: str, *, written_at: datetime.datetime | None = None
) -> None:
    """Write the segmented customers and the summary report into `folder`.

    The customers are a committed export: an earlier one is replaced only by a complete one.
    """
    commit_export(analysis.segmented, f"{folder}/{CUSTOMERS_NAME}")
    write_report(
        analysis.summary,
        analysis.clustering,
        analysis.k,
        f"{folder}/{REPORT_NAME}",
        written_at=written_at,
    )
