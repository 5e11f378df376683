"""One query per operator, each over the whole tables of a folder.

Results are rounded where two engines may differ in the last digits of a double, and
timestamps are returned without a zone.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage import schema as S
from patronage.operators import charts, elbow, model_checks, segments
from patronage.operators import measures as M
from patronage.operators import profile as P
from patronage.operators.cleaning import clean, cleaning_stats, preview
from patronage.operators.clustering import (
    choose_model,
    cluster,
    cost_sweep,
    dealt,
    fit_kmeans,
    fit_mixture,
    label,
    silhouette,
    sweep_models,
)
from patronage.operators.features import scale
from patronage.operators.quartiles import quartiles, tile_columns
from patronage.plans.jobs import (
    ClusterAnalysis,
    CustomerAnalysis,
    clustering_only,
    export,
    full_analysis,
    rfm_only,
)
from patronage.sources import tables
from patronage.sources.exports import (
    CUSTOMERS_NAME,
    REPORT_NAME,
    commit_export,
    read_export,
    report_header,
    report_lines,
)
from patronage.sources.transactions import read_checked
from patronage.staging import _application_folder, stage

# Amounts in the test tables are about a thousand times those the ladder was made for.
RULES = S.SegmentRules().scale_money(1000)
SCORES = "RFM_Score"
CURVE_KS = range(2, 11)
# Limits at which some groups of the test tables fall into every branch of the ladder.
ALL_BRANCHES = S.SegmentRules(
    vip_recency=50, vip_frequency=12, vip_monetary=2_500_000,
    loyal_recency=100, loyal_frequency=11, loyal_monetary=2_200_000,
    new_recency=60, inactive_recency=400, high_monetary=2_100_000,
)
ACTIONS_EACH = len(segments.ACTIONS["VIP"])
REPORTED_AT = datetime.datetime(2024, 5, 6, 7, 8, 9)

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame) -> DataFrame:
    stamps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in stamps})


def _rounded(df: DataFrame, **places: int) -> DataFrame:
    # Rounding to more places first settles ties that noise in the last digit would decide.
    return df.withColumns({c: F.round(F.round(c, n + 3), n) for c, n in places.items()})


def _rfm(spark: SparkSession, folder: str, dirty: bool = False) -> DataFrame:
    return M.rfm(tables.invoices(spark, folder, dirty=dirty))


def _customers(spark: SparkSession, folder: str, dirty: bool = False) -> DataFrame:
    return quartiles(_rfm(spark, folder, dirty))


def _by_recency(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their quartile of Recency alone."""
    return quartiles(_rfm(spark, folder), measures=["Recency"])


def _named(customers: DataFrame, key: str, rules: S.SegmentRules = RULES) -> DataFrame:
    return segments.name_groups(P.profile(customers, key), key, rules)


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(tables.lines(spark, folder, country=True))


def clean_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(clean(tables.lines(spark, folder, dirty=True)))


def _transaction_file(spark: SparkSession, folder: str) -> str:
    """The dirty lines as CSV files, among them a record per supplier that fits no declared type."""
    path = _scratch(spark, "transactions")
    lines = tables.lines(spark, folder, dirty=True)
    lines.write.option("header", True).csv(path)
    supplier = F.col("s_suppkey")
    broken = tables.table(spark, folder, "supplier").select(
        supplier.alias("CustomerID"),
        F.col("s_name").alias("InvoiceNo"),
        F.lit("2020-01-01 00:00:00").alias("InvoiceDate"),
        F.when(supplier % 2 == 0, "many").otherwise("1.0").alias("Quantity"),
        F.when(supplier % 2 == 1, "free").otherwise("1.0").alias("UnitPrice"),
    )
    broken.write.mode("append").option("header", True).csv(path)
    return path


def clean_rows_csv(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(clean(read_checked(spark, _transaction_file(spark, folder)).lines))


def csv_records(spark: SparkSession, folder: str) -> DataFrame:
    return read_checked(spark, _transaction_file(spark, folder)).counts()


def clean_rows_dated(spark: SparkSession, folder: str) -> DataFrame:
    lines = tables.lines(spark, folder, dirty=True)
    return _plain(clean(lines, on_bad_date="drop"))


def clean_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(tables.cleaning_stats(spark, folder, dirty=True), retention_rate=6)


def clean_stats_from_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(cleaning_stats(tables.lines(spark, folder, dirty=True)), retention_rate=6)


def preview_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(preview(clean(tables.lines(spark, folder, dirty=True))))


def snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(M.snapshot(tables.invoices(spark, folder, dirty=True), "LastDate"))


def rfm_base(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_plain(_rfm(spark, folder)), AvgTransactionValue=6)


def rfm_from_lines(spark: SparkSession, folder: str) -> DataFrame:
    facts = M.invoice_facts(clean(tables.lines(spark, folder)))
    return _rounded(_plain(M.rfm(facts)), AvgTransactionValue=6)


def rfm_dirty(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_plain(_rfm(spark, folder, dirty=True)), AvgTransactionValue=6)


def rfm_quartiles(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_plain(_customers(spark, folder)), AvgTransactionValue=6)


def rfm_dirty_quartiles(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("R_Quartile", "F_Quartile", "M_Quartile", SCORES)
    return _customers(spark, folder, dirty=True).select("CustomerID", *columns)


def undated_quartiles(spark: SparkSession, folder: str) -> DataFrame:
    """Some customers have no readable date at all: null Recency, first quartile."""
    undated = F.col("CustomerID") % 7 == 3
    facts = tables.invoices(spark, folder)
    facts = facts.withColumns({c: F.when(~undated, F.col(c)) for c in ("FirstDate", "LastDate")})
    columns = ("Recency", "R_Quartile", "F_Quartile", "M_Quartile", SCORES)
    return quartiles(M.rfm(facts)).select("CustomerID", *columns)


def customer_kpis(spark: SparkSession, folder: str) -> DataFrame:
    means = {f"{m}_mean": 4 for m in S.MEASURES}
    return _rounded(P.customer_kpis(_rfm(spark, folder)), **means)


def score_projection(spark: SparkSession, folder: str) -> DataFrame:
    labelled = _customers(spark, folder).withColumn("prediction", F.col("R_Quartile"))
    return _rounded(P.scored(labelled), AvgTransactionValue=6)


def profile_by_quartile(spark: SparkSession, folder: str) -> DataFrame:
    return P.profile(_customers(spark, folder), "R_Quartile")


def profile_by_score(spark: SparkSession, folder: str) -> DataFrame:
    return P.profile(_customers(spark, folder), SCORES)


def group_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return P.group_sizes(_by_recency(spark, folder), "R_Quartile")


def group_means(spark: SparkSession, folder: str) -> DataFrame:
    means = {f"{m}_mean": 4 for m in S.MEASURES}
    return _rounded(P.group_means(_by_recency(spark, folder), "R_Quartile"), **means)


def monetary_p95(spark: SparkSession, folder: str) -> DataFrame:
    rfm = _rfm(spark, folder)
    bound = charts.quantile(rfm, "Monetary", charts.MONETARY_QUANTILE)
    return rfm.agg(
        F.round(F.lit(bound), 4).alias("p95"),
        F.count_if(F.col("Monetary") < F.lit(bound)).alias("customers_below"),
    )


def approximate_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Per measure: probabilities asked for, and those whose value's rank is off by more than 1 / 1000."""
    rfm = _rfm(spark, folder)
    found = stage(charts.approximate_quantiles(rfm, S.MEASURES, [i / 50 for i in range(1, 50)], accuracy=1000), "approximate")
    errors = charts.rank_errors(rfm, found)
    return errors.groupBy("measure").agg(
        F.count("*").alias("probabilities"), F.count_if(F.col("rank_error") > 1 / 1000).alias("outside")
    )


def frequency_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Measures from daily sketches beside the exact Frequency, which the estimate must be near."""
    days = stage(M.daily_facts(clean(tables.lines(spark, folder))), "days")
    exact = _rfm(spark, folder).select("CustomerID", F.col("Frequency").alias("exact"))
    joined = M.rfm_of_days(days).join(exact, "CustomerID")
    error = F.abs(F.col("Frequency") - F.col("exact")) / F.col("exact")
    return joined.select(
        "CustomerID", "Recency", F.col("exact").alias("Frequency"), "Monetary", "TotalTransactions",
        (error <= 0.05).cast("int").alias("estimate_near"),
    )


def vip_count(spark: SparkSession, folder: str) -> DataFrame:
    return segments.vip_count(_named(_customers(spark, folder), SCORES))


def revenue(spark: SparkSession, folder: str) -> DataFrame:
    per_group = segments.revenue(_by_recency(spark, folder), "R_Quartile")
    return _rounded(per_group, estimated_revenue=2, exact_revenue=2)


def customer_total(spark: SparkSession, folder: str) -> DataFrame:
    return segments.customer_total(P.profile(_customers(spark, folder), "R_Quartile"))


def segment_groups(spark: SparkSession, folder: str) -> DataFrame:
    named = _named(_customers(spark, folder), "R_Quartile")
    return named.select("R_Quartile", "CustomerID_count", "Segment_Name", "Description")


def segment_scores(spark: SparkSession, folder: str) -> DataFrame:
    named = _named(_customers(spark, folder), SCORES)
    return named.select(SCORES, "CustomerID_count", "Segment_Name", "Description")


def segment_all_branches(spark: SparkSession, folder: str) -> DataFrame:
    named = _named(_customers(spark, folder), SCORES, ALL_BRANCHES)
    return named.select(SCORES, "CustomerID_count", "Segment_Name", "Description")


def recommend_all_kinds(spark: SparkSession, folder: str) -> DataFrame:
    return segments.recommend(_named(_customers(spark, folder), SCORES, ALL_BRANCHES))


def lookup_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of the groups that have no name get a numbered cluster."""
    customers = _customers(spark, folder)
    named = stage(_named(customers, SCORES).where(F.col(SCORES) % 2 == 0), "named")
    return segments.attach_segments(customers, named, SCORES).select("CustomerID", SCORES, "Segment")


def profile_order(spark: SparkSession, folder: str) -> DataFrame:
    """The profile's groups in the order in which it lists them."""
    summary = segments.segment_summary(_named(_customers(spark, folder), SCORES), SCORES)
    listed = summary.withColumn("at", F.monotonically_increasing_id())
    # One row per group.
    position = F.row_number().over(Window.orderBy("at"))
    return listed.select(SCORES, position.alias("position"))


def report_text(spark: SparkSession, folder: str) -> DataFrame:
    """The report's lines at a fixed time and score, numbered in their order."""
    summary = segments.segment_summary(_named(_customers(spark, folder), "R_Quartile"), "R_Quartile")
    customers = summary.agg(F.sum("customers")).first()[0]
    header = report_header(REPORTED_AT, customers, 4, S.KMEANS_NAME, 0.5)
    lines = report_lines(summary, header, "R_Quartile").withColumn("at", F.monotonically_increasing_id())
    position = F.row_number().over(Window.orderBy("at"))
    return lines.select(position.alias("position"), "value")


def export_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """Segmented customers from a finished export, its columns numbered in their order."""
    path = _scratch(spark, "export")
    named = segments.name_customers(_customers(spark, folder), RULES)
    commit_export(named.select("CustomerID", *S.MEASURES, "TotalTransactions", SCORES, "Segment"), path)
    back = read_export(spark, path)
    return back.withColumn("column_order", F.lit(",".join(back.columns)))


def segment_customers(spark: SparkSession, folder: str) -> DataFrame:
    named = segments.name_customers(_rfm(spark, folder), RULES)
    return named.select("CustomerID", *S.MEASURES, "Segment")


def segment_lookup(spark: SparkSession, folder: str) -> DataFrame:
    customers = _customers(spark, folder)
    named = stage(_named(customers, SCORES), "named")
    return segments.attach_segments(customers, named, SCORES).select(
        "CustomerID", SCORES, "Segment"
    )


def recommendations(spark: SparkSession, folder: str) -> DataFrame:
    return segments.recommend(_named(_customers(spark, folder), SCORES))


def impact_summary(spark: SparkSession, folder: str) -> DataFrame:
    named = _named(_customers(spark, folder), SCORES)
    return _rounded(segments.impact_summary(named), revenue=2)


def segment_summary(spark: SparkSession, folder: str) -> DataFrame:
    named = _named(_customers(spark, folder), "R_Quartile")
    return _rounded(segments.segment_summary(named, "R_Quartile"), revenue=2)


def scaled_features(spark: SparkSession, folder: str) -> DataFrame:
    features, _ = scale(_rfm(spark, folder))
    values = vector_to_array("features")
    return features.select(
        "CustomerID",
        *(F.round(values[n], 6).alias(f"{m}_scaled") for n, m in enumerate(S.MEASURES)),
    )


def silhouette_fixed(spark: SparkSession, folder: str) -> DataFrame:
    features, _ = scale(_by_recency(spark, folder))
    score = silhouette(features, "R_Quartile")
    return spark.createDataFrame([(round(score, 6),)], "silhouette double")


def model_choice(spark: SparkSession, folder: str) -> DataFrame:
    """The model chosen for two scores of fixed labels, for the same the other way round, and for a tie."""
    features, _ = scale(_customers(spark, folder))
    by_recency, by_money = (silhouette(features, f"{m}_Quartile") for m in "RM")
    cases = {"as_is": (by_recency, by_money), "swapped": (by_money, by_recency), "tie": (by_money, by_money)}
    rows = [(name, round(k, 6), round(g, 6), choose_model(k, g)) for name, (k, g) in cases.items()]
    return spark.createDataFrame(rows, "case string, kmeans double, mixture double, chosen string")


def _curve(spark: SparkSession, folder: str) -> DataFrame:
    """A repeatable cost curve: squares of Recency within its k tiles, for each k."""
    rfm = _rfm(spark, folder)
    tiles = tile_columns(rfm, [("Recency", k) for k in CURVE_KS])
    per_tile = (
        rfm.select(
            F.col("Recency").cast("bigint").alias("r"),
            F.explode(
                F.array(
                    *(
                        F.struct(F.lit(k).alias("k"), tile.alias("tile"))
                        for (_, k), tile in tiles.items()
                    )
                )
            ).alias("t"),
        )
        .groupBy("t.k", "t.tile")
        .agg(F.expr("sum(r * r) - cast(sum(r) AS double) * sum(r) / count(*)").alias("squares"))
    )
    return per_tile.groupBy("k").agg(F.round(F.sum("squares"), 4).alias("WSSSE"))


def elbow_table(spark: SparkSession, folder: str) -> DataFrame:
    return elbow.reductions(_curve(spark, folder))


def elbow_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(elbow.elbow_ratios(_curve(spark, folder)), ratio=6)


def elbow_pick(spark: SparkSession, folder: str) -> DataFrame:
    return elbow.elbow_pick(_curve(spark, folder))


def _histogram(make: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _rounded(make(_rfm(spark, folder)), bin_low=4, bin_high=4)

    return query


def _grid(x: str, y: str, mean_of: str, key: str | None = None) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        customers = _by_recency(spark, folder) if key else _rfm(spark, folder)
        cells = charts.grid(customers, x, y, mean_of, key=key)
        return _rounded(cells, **{f"{mean_of}_mean": 4})

    return query


def _boxes(customers: DataFrame, column: str, key: str) -> DataFrame:
    numbers = ("q1", "median", "q3", "whisker_low", "whisker_high")
    return _rounded(charts.box_statistics(customers, column, key), **dict.fromkeys(numbers, 4))


def box_by_customer_group(spark: SparkSession, folder: str) -> DataFrame:
    """Many groups, each spread over all customers."""
    grouped = _rfm(spark, folder).withColumn("customer_group", F.col("CustomerID") % 150)
    return _boxes(grouped, "Monetary", "customer_group")


def tiles_100(spark: SparkSession, folder: str) -> DataFrame:
    rfm = _rfm(spark, folder)
    tiles = tile_columns(rfm, [(m, 100) for m in S.MEASURES])
    return rfm.select("CustomerID", *(tiles[m, 100].alias(f"{m}_tile") for m in S.MEASURES))


def _box(column: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _boxes(_by_recency(spark, folder), column, "R_Quartile")

    return query


def cube_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return charts.cube(_by_recency(spark, folder), key="R_Quartile")


def hist_frequency_10(spark: SparkSession, folder: str) -> DataFrame:
    """Bound at a number of invoices that many customers reach."""
    return _rounded(charts.frequency_histogram(_rfm(spark, folder), bound=10), bin_low=4, bin_high=4)


def _job_sources(spark: SparkSession, folder: str) -> dict:
    return {"lines": tables.lines(spark, folder, dirty=True), "invoices": tables.invoices(spark, folder, dirty=True)}


def _customer_totals(analysis: CustomerAnalysis) -> DataFrame:
    """What a description of customers adds up to, as one row."""
    cleaning = analysis.cleaning.select("original_count", "cleaned_count")
    kpis = analysis.kpis.select("customers", F.round("Monetary_mean", 2).alias("mean_value"))
    scores = analysis.customers.agg(F.sum(SCORES).alias("score_sum"))
    charted = {name: chart.agg(F.sum("customers").alias(name)) for name, chart in analysis.charts.items()}
    totals = cleaning
    for part in (kpis, scores, *charted.values(), analysis.preview.agg(F.count("*").alias("preview_rows"))):
        # One row each.
        totals = totals.withColumns({c: part.select(c).scalar() for c in part.columns})
    return totals.withColumn("snapshot_day", F.date_format(analysis.snapshot.scalar(), "yyyy-MM-dd"))


def _cluster_totals(analysis: ClusterAnalysis) -> DataFrame:
    """What an analysis of clusters adds up to, whatever the clusters are, as one row."""
    kinds = analysis.recommendations.select("Segment_Name").distinct()
    profile = analysis.profile.agg(
        F.count("*").alias("clusters"),
        F.sum("CustomerID_count").alias("profiled"),
        (F.max("prediction") + 1).cast("bigint").alias("numbers"),
    )
    parts = [
        profile,
        analysis.impact.select(F.col("customers").alias("impact_customers")),
        analysis.unscaled,
        analysis.recommendations.agg(F.count("*").alias("actions")).select(
            (F.col("actions") - ACTIONS_EACH * kinds.agg(F.count("*")).scalar()).alias("actions_missing")
        ),
        analysis.summary.agg(F.sum("customers").alias("summary_customers")),
    ]
    parts += [chart.agg(F.sum("customers").alias(name)) for name, chart in analysis.charts.items() if name != "means"]
    totals = analysis.segmented.agg(
        F.count("Segment").alias("segmented"), F.round(F.sum("Monetary"), 2).alias("revenue"), F.sum(SCORES).alias("scores")
    )
    for part in parts:
        part = stage(part, "totals")
        totals = totals.withColumns({c: part.select(c).scalar() for c in part.columns})
    return totals


def job_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _customer_totals(rfm_only(**_job_sources(spark, folder)))


def job_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return _cluster_totals(clustering_only(**_job_sources(spark, folder), max_k=None, rules=RULES))


def job_full(spark: SparkSession, folder: str) -> DataFrame:
    """A whole analysis with its sweep, exported and read back."""
    analysis = full_analysis(**_job_sources(spark, folder), max_k=4, rules=RULES)
    path = _scratch(spark, "job")
    export(analysis.clusters, path, written_at=REPORTED_AT)
    exported = read_export(spark, f"{path}/{CUSTOMERS_NAME}").agg(F.count("*").alias("exported")).first()[0]
    report = spark.read.text(f"{path}/{REPORT_NAME}").count()
    totals = _customer_totals(analysis.customers).select("original_count", "cleaned_count", "customers", "score_sum", "hist_recency")
    clusters = stage(_cluster_totals(analysis.clusters).select("segmented", "clusters", "profiled", "grid_rf_by_cluster"), "totals")
    totals = totals.withColumns({c: clusters.select(c).scalar() for c in clusters.columns})
    return totals.withColumns(
        {
            "exported": F.lit(exported).cast("bigint"),
            "report_lines": F.lit(report).cast("bigint"),
            "sweep_steps": F.lit(analysis.clusters.elbow["table"].count()).cast("bigint"),
        }
    )


def kmeans_customers(spark: SparkSession, folder: str) -> DataFrame:
    labelled = label(_rfm(spark, folder), fit_kmeans)
    return labelled.select("CustomerID", *S.MEASURES, "prediction")


def gmm_customers(spark: SparkSession, folder: str) -> DataFrame:
    labelled = label(_rfm(spark, folder), fit_mixture)
    return labelled.select("CustomerID", *S.MEASURES, "prediction")


def kmeans_check(spark: SparkSession, folder: str) -> DataFrame:
    rfm = _rfm(spark, folder)
    features, scaler = scale(dealt(rfm))
    model = fit_kmeans(features, 4)
    labelled = stage(model.transform(scaler.transform(rfm)), "labels")
    return model_checks.kmeans_check(labelled, model)


def mixture_check(spark: SparkSession, folder: str) -> DataFrame:
    rfm = _rfm(spark, folder)
    features, scaler = scale(dealt(rfm))
    model = fit_mixture(features, 4)
    labelled = stage(model.transform(scaler.transform(rfm)), "labels")
    return model_checks.mixture_check(labelled, model)


def sweep_check(spark: SparkSession, folder: str) -> DataFrame:
    """Per k: customers counted, and whether the cost of its centres differs from the trained one."""
    features, _ = scale(_rfm(spark, folder))
    models = sweep_models(features)
    trained = spark.createDataFrame(
        [(k, float(model.summary.trainingCost)) for k, model in models.items()], "k int, trained double"
    )
    found = model_checks.costs(features, model_checks.centre_table(spark, models)).join(trained, "k")
    # the trained cost is that of the last step, before the centres moved once more
    differs = (F.col("cost") > F.col("trained") * (1 + 1e-9)) | (F.col("cost") < F.col("trained") * 0.99)
    return found.select("k", "customers", differs.cast("int").alias("differing"))


def labels_by_partitioning(spark: SparkSession, folder: str) -> DataFrame:
    """Customers whose cluster differs between tables of 3 and of 11 partitions, for each model."""
    rfm = stage(_rfm(spark, folder), "rfm")
    found = []
    for name, fit in (("kmeans", fit_kmeans), ("mixture", fit_mixture)):
        first, second = (label(rfm.repartition(n, *by), fit) for n, by in ((3, ["Frequency"]), (11, ["Recency"])))
        second = second.select("CustomerID", F.col("prediction").alias("other"))
        both = first.join(second, "CustomerID", "full")
        counts = both.agg(F.count("*").alias("customers"), F.count_if(~F.col("prediction").eqNullSafe(F.col("other"))).alias("differing"))
        found.append(counts.select(F.lit(name).alias("model"), "customers", "differing"))
    return found[0].union(found[1])


def model_scores(spark: SparkSession, folder: str) -> DataFrame:
    return cluster(_rfm(spark, folder)).scores()


def sweep(spark: SparkSession, folder: str) -> DataFrame:
    features, _ = scale(_rfm(spark, folder))
    return elbow.reductions(cost_sweep(features))


def segmented_customers(spark: SparkSession, folder: str) -> DataFrame:
    analysis = clustering_only(
        tables.lines(spark, folder),
        invoices=tables.invoices(spark, folder),
        max_k=None,
        rules=RULES,
    )
    return analysis.segmented


def point_sample(spark: SparkSession, folder: str) -> DataFrame:
    customers = _by_recency(spark, folder)
    columns = ("CustomerID", *S.MEASURES, "R_Quartile", "group_customers")
    return charts.point_sample(customers, 100, "R_Quartile").select(*columns)


QUERIES: dict[str, Query] = {
    "transactions": transactions,
    "clean_rows": clean_rows,
    "clean_rows_csv": clean_rows_csv,
    "csv_records": csv_records,
    "clean_rows_dated": clean_rows_dated,
    "clean_stats": clean_stats,
    "clean_stats_from_lines": clean_stats_from_lines,
    "preview": preview_rows,
    "snapshot": snapshot,
    "rfm_base": rfm_base,
    "rfm_from_lines": rfm_from_lines,
    "rfm_dirty": rfm_dirty,
    "rfm_quartiles": rfm_quartiles,
    "rfm_dirty_quartiles": rfm_dirty_quartiles,
    "undated_quartiles": undated_quartiles,
    "customer_kpis": customer_kpis,
    "score_projection": score_projection,
    "profile_by_quartile": profile_by_quartile,
    "profile_by_score": profile_by_score,
    "group_sizes": group_sizes,
    "group_means": group_means,
    "monetary_p95": monetary_p95,
    "approximate_quantiles": approximate_quantiles,
    "frequency_sketches": frequency_sketches,
    "vip_count": vip_count,
    "revenue": revenue,
    "customer_total": customer_total,
    "segment_groups": segment_groups,
    "segment_scores": segment_scores,
    "segment_all_branches": segment_all_branches,
    "recommend_all_kinds": recommend_all_kinds,
    "lookup_fallback": lookup_fallback,
    "profile_order": profile_order,
    "report_text": report_text,
    "export_read_back": export_read_back,
    "segment_customers": segment_customers,
    "segment_lookup": segment_lookup,
    "recommendations": recommendations,
    "impact_summary": impact_summary,
    "segment_summary": segment_summary,
    "scaled_features": scaled_features,
    "silhouette_fixed": silhouette_fixed,
    "model_choice": model_choice,
    "elbow_table": elbow_table,
    "elbow_ratio": elbow_ratio,
    "elbow_pick": elbow_pick,
    "hist_recency": _histogram(charts.recency_histogram),
    "hist_frequency": _histogram(charts.frequency_histogram),
    "hist_monetary": _histogram(charts.monetary_histogram),
    "grid_rf": _grid("Recency", "Frequency", "Monetary"),
    "grid_fm": _grid("Frequency", "Monetary", "Recency"),
    "grid_rm": _grid("Recency", "Monetary", "Frequency"),
    "hist_frequency_10": hist_frequency_10,
    "grid_by_group": _grid("Recency", "Frequency", "Monetary", "R_Quartile"),
    "grid_fm_by_group": _grid("Frequency", "Monetary", "Recency", "R_Quartile"),
    "grid_rm_by_group": _grid("Recency", "Monetary", "Frequency", "R_Quartile"),
    "cube_by_group": cube_by_group,
    "box_recency": _box("Recency"),
    "box_monetary": _box("Monetary"),
    "box_by_customer_group": box_by_customer_group,
    "tiles_100": tiles_100,
    "kmeans_customers": kmeans_customers,
    "gmm_customers": gmm_customers,
    "kmeans_check": kmeans_check,
    "mixture_check": mixture_check,
    "sweep_check": sweep_check,
    "labels_by_partitioning": labels_by_partitioning,
    "model_scores": model_scores,
    "cost_sweep": sweep,
    "segmented_customers": segmented_customers,
    "point_sample": point_sample,
    "job_customers": job_customers,
    "job_clusters": job_clusters,
    "job_full": job_full,
}
