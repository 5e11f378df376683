"""The segment ladder, its lookups and the summaries."""

import pytest
from pyspark.sql import functions as F

from patronage import schema as S
from patronage.operators import profile as P
from patronage.operators import segments as G
from patronage.staging import stage

RFM = "CustomerID bigint, Recency int, Frequency bigint, Monetary double"
PROFILE = (
    "prediction int, CustomerID_count bigint, Recency_mean double, Frequency_mean double,"
    " Monetary_mean double"
)


@pytest.mark.parametrize(
    "recency, frequency, monetary, segment",
    [
        (49, 11, 2000.01, S.VIP),
        (50, 11, 2000.01, S.LOYAL),
        (49, 10, 2000.01, S.LOYAL),
        (49, 11, 2000.0, S.LOYAL),
        (99, 6, 1000.01, S.LOYAL),
        (100, 6, 1000.01, S.HIGH_VALUE),
        (99, 5, 1000.01, S.HIGH_VALUE),
        (99, 6, 1000.0, S.HIGH_VALUE),
        (29, 1, 1.0, S.NEW),
        (30, 1, 1.0, "Regular"),
        (180, 1, 500.0, "Regular"),
        (181, 1, 500.0, S.INACTIVE),
        (181, 50, 9000.0, S.INACTIVE),
        (180, 1, 500.01, S.HIGH_VALUE),
        (None, 50, 9000.0, S.HIGH_VALUE),
    ],
)
def test_limits_are_strict(spark, recency, frequency, monetary, segment):
    df = spark.createDataFrame([(1, recency, frequency, monetary)], RFM)
    assert G.name_customers(df).first().Segment == segment


def test_money_limits_scale():
    rules = S.SegmentRules().scale_money(1000)
    assert (rules.vip_monetary, rules.loyal_monetary, rules.high_monetary) == (2e6, 1e6, 5e5)
    assert rules.vip_recency == 50


@pytest.fixture
def named(spark):
    """Labels 0, 2, 3, 5: a gap, two groups of one name and one without."""
    profile = spark.createDataFrame(
        [
            (0, 10, 10.0, 20.0, 3000.0),
            (2, 5, 10.0, 15.0, 2500.5),
            (3, 7, 200.0, 1.0, 10.0),
            (5, 1, 60.0, 1.0, 100.25),
        ],
        PROFILE,
    )
    return stage(G.name_groups(profile), "named")


def test_groups_are_named_by_label_not_position(spark, named):
    names = {r.prediction: r.Segment_Name for r in named.collect()}
    assert names == {0: S.VIP, 2: S.VIP, 3: S.INACTIVE, 5: S.UNNAMED_PREFIX + "5"}
    customers = spark.createDataFrame(
        [(n, n % 6) for n in range(12)], "CustomerID bigint, prediction int"
    )
    found = {r.prediction: r.Segment for r in G.attach_segments(customers, named).collect()}
    assert found == names | {1: S.UNNAMED_PREFIX + "1", 4: S.UNNAMED_PREFIX + "4"}
    assert G.attach_segments(customers, named).count() == 12


def test_each_name_gets_its_numbered_actions(named):
    rows = G.recommend(named).collect()
    by_name = {}
    for r in rows:
        by_name.setdefault(r.Segment_Name, []).append((r["rank"], r.action))
    expected = {S.VIP: "VIP", S.INACTIVE: "Inactive", S.UNNAMED_PREFIX + "5": "Other"}
    assert by_name == {
        name: list(enumerate(G.ACTIONS[kind], 1)) for name, kind in expected.items()
    }


def test_totals(named):
    assert G.customer_total(named).first()[0] == 23
    assert G.vip_count(named).first()[0] == 15
    impact = G.impact_summary(named).first()
    assert (impact.customers, impact.vip_customers) == (23, 15)
    assert impact.revenue == pytest.approx(30000 + 12502.5 + 70 + 100.25)
    assert G.vip_count(named.filter("prediction = 3")).first()[0] == 0


def test_lookup_is_a_broadcast(spark, named):
    customers = spark.range(1000).select(
        F.col("id").alias("CustomerID"), (F.col("id") % 6).cast("int").alias("prediction")
    )
    plan = G.attach_segments(customers, named)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_lookup_keeps_the_column_order(spark, named):
    customers = spark.createDataFrame([(1, 2.0, 3)], "CustomerID bigint, x double, prediction int")
    assert G.attach_segments(customers, named).columns == ["CustomerID", "x", "prediction", "Segment"]


def test_descriptions_follow_the_rules(spark):
    rules = S.SegmentRules(inactive_recency=90)
    profile = spark.createDataFrame([(0, 1, 120.0, 1.0, 10.0)], PROFILE)
    assert G.name_groups(profile, rules=rules).first().Description == "recency over 90 days"


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(
        [
            (1, 10, 2, 1.005, 4, 0.25, 111, 0),
            (2, 20, 3, 2.0, 5, 0.40, 112, 0),
            (3, 7, 1, 9.99, 1, 9.99, 444, 1),
        ],
        f"{RFM}, TotalTransactions bigint, AvgTransactionValue double, RFM_Score int,"
        " prediction int",
    )


def test_profile_of_groups(customers):
    rows = {r.prediction: r for r in P.profile(customers).collect()}
    assert rows[0].CustomerID_count == 2
    assert (rows[0].Recency_mean, rows[0].Recency_min, rows[0].Recency_max) == (15.0, 10, 20)
    assert rows[0].Recency_std == 7.07
    assert rows[0].AvgTransactionValue_mean == 0.33
    assert rows[0].RFM_Score_mean == 111.5
    assert rows[1].Recency_std is None and rows[1].Monetary_mean == 9.99
    expected = ["prediction", "CustomerID_count"]
    expected += [f"{m}_{s}" for m in S.MEASURES for s in ("mean", "std", "min", "max")]
    expected += ["TotalTransactions_mean", "AvgTransactionValue_mean", "RFM_Score_mean"]
    assert P.profile(customers).columns == expected
    assert [r.prediction for r in P.profile(customers).collect()] == [0, 1]


def test_groups_come_in_order(customers):
    assert [tuple(r) for r in P.group_sizes(customers).collect()] == [(0, 2), (1, 1)]
    assert [r.prediction for r in P.group_means(customers).collect()] == [0, 1]
    assert P.scored(customers).columns == list(S.SCORED_COLUMNS)
