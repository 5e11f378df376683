"""The same queries as SQL for a second engine, written from the definitions."""

from __future__ import annotations

from patronage import schema as S
from patronage.functions.scalars import segment_descriptions
from patronage.operators.segments import ACTIONS
from patronage.plans.catalog import ALL_BRANCHES, CURVE_KS, RULES

_MONEY = 1000

_LINES = """
lines AS (
  SELECT o_custkey AS "CustomerID", CAST(o_orderkey AS VARCHAR) AS "InvoiceNo",
         o_orderdate AS "InvoiceDate", l_quantity AS "Quantity",
         l_extendedprice / l_quantity AS "UnitPrice"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_CLEANED = f"""{_LINES},
cleaned AS (
  SELECT *, round("Quantity" * "UnitPrice", 2) AS "TotalAmount"
  FROM lines WHERE "CustomerID" IS NOT NULL AND "Quantity" > 0 AND "UnitPrice" > 0
)"""

_DIRTY_LINES = """
lines AS (
  SELECT CASE WHEN o_orderkey % 20 <> 0 THEN o_custkey END AS "CustomerID",
         CAST(o_orderkey AS VARCHAR) AS "InvoiceNo",
         CASE WHEN o_orderkey % 101 = 0 THEN 'not a date'
              WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%-m/%-d/%Y %-H:%M')
              WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%-d/%-m/%Y %-H:%M')
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS "InvoiceDate",
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 1
              THEN -l_quantity ELSE l_quantity END AS "Quantity",
         CASE WHEN l_discount = 0 AND l_linenumber = 2
              THEN 0 ELSE l_extendedprice / l_quantity END AS "UnitPrice"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_PARSED = """coalesce(try_strptime("InvoiceDate", '%m/%d/%Y %H:%M'),
                      try_strptime("InvoiceDate", '%d/%m/%Y %H:%M'),
                      try_strptime("InvoiceDate", '%Y-%m-%d %H:%M:%S'))"""

_DIRTY_CLEANED = f"""{_DIRTY_LINES},
cleaned AS (
  SELECT "CustomerID", "InvoiceNo", {_PARSED} AS "InvoiceDate", "Quantity", "UnitPrice",
         round("Quantity" * "UnitPrice", 2) AS "TotalAmount"
  FROM lines WHERE "CustomerID" IS NOT NULL AND "Quantity" > 0 AND "UnitPrice" > 0
)"""

_MEASURES = """,
rfm AS (
  SELECT "CustomerID",
         CAST(date_diff('day', max("InvoiceDate"),
                        (SELECT max("InvoiceDate") FROM cleaned)) AS INTEGER) AS "Recency",
         count(DISTINCT "InvoiceNo") AS "Frequency",
         CAST(sum(CAST("TotalAmount" AS DECIMAL(18, 2))) AS DOUBLE) AS "Monetary",
         count("InvoiceNo") AS "TotalTransactions",
         CAST(sum(CAST("TotalAmount" AS DECIMAL(18, 2))) AS DOUBLE) / count(*)
           AS "AvgTransactionValue",
         min("InvoiceDate") AS "FirstPurchaseDate",
         max("InvoiceDate") AS "LastPurchaseDate"
  FROM cleaned GROUP BY "CustomerID"
)"""


def _tile(measure: str, tiles: int = 4) -> str:
    order = f'"{measure}" ASC NULLS FIRST, "CustomerID"'
    return f"CAST(ntile({tiles}) OVER (ORDER BY {order}) AS INTEGER)"


_TILES = f""",
tiled AS (
  SELECT *, {_tile("Recency")} AS "R_Quartile", {_tile("Frequency")} AS "F_Quartile",
         {_tile("Monetary")} AS "M_Quartile"
  FROM rfm
),
customers AS (
  SELECT *, "R_Quartile" * 100 + "F_Quartile" * 10 + "M_Quartile" AS "RFM_Score" FROM tiled
)"""

def _half_up(expression: str, places: int = 2) -> str:
    """Round half-up on the decimal digits."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38, {places + 3})), {places}) AS DOUBLE)"


_RFM = _CLEANED + _MEASURES
_CUSTOMERS = _RFM + _TILES
_DIRTY_CUSTOMERS = _DIRTY_CLEANED + _MEASURES + _TILES

# As the measures, but some customers have no readable date.
_UNDATED = """,
dated AS (SELECT *, CASE WHEN "CustomerID" % 7 <> 3 THEN "InvoiceDate" END AS day FROM cleaned),
rfm AS (
  SELECT "CustomerID",
         CAST(date_diff('day', max(day), (SELECT max(day) FROM dated)) AS INTEGER) AS "Recency",
         count(DISTINCT "InvoiceNo") AS "Frequency",
         CAST(sum(CAST("TotalAmount" AS DECIMAL(18, 2))) AS DOUBLE) AS "Monetary"
  FROM dated GROUP BY "CustomerID"
)"""

_BASE_COLUMNS = f""""CustomerID", "Recency", "Frequency", "Monetary", "TotalTransactions",
  {_half_up('"AvgTransactionValue"', 6)} AS "AvgTransactionValue",
  "FirstPurchaseDate", "LastPurchaseDate\""""


def _profile(key: str) -> str:
    functions = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    columns = []
    for measure in S.MEASURES:
        for name, function in functions.items():
            value = f'{function}("{measure}")'
            if name in ("mean", "std"):
                value = _half_up(value)
            columns.append(f'{value} AS "{measure}_{name}"')
    for measure in ("TotalTransactions", "AvgTransactionValue", "RFM_Score"):
        columns.append(f'{_half_up(f"avg({chr(34)}{measure}{chr(34)})")} AS "{measure}_mean"')
    listed = ",\n         ".join(columns)
    return f""",
profile AS (
  SELECT "{key}", count("CustomerID") AS "CustomerID_count",
         {listed}
  FROM customers GROUP BY "{key}"
)"""


# Limits in the order of the ladder: recency, frequency and value of the first two rungs, then one each.
_USUAL_LIMITS = (50, 10, 2000 * _MONEY, 100, 5, 1000 * _MONEY, 30, 180, 500 * _MONEY)
_ALL_LIMITS = (50, 12, 2500000, 100, 11, 2200000, 60, 400, 2100000)


def _ladder(recency: str, frequency: str, monetary: str, fallback: str, limits=_USUAL_LIMITS) -> str:
    vip_r, vip_f, vip_m, loyal_r, loyal_f, loyal_m, new_r, inactive_r, high_m = limits
    return f"""CASE
    WHEN {recency} < {vip_r} AND {frequency} > {vip_f} AND {monetary} > {vip_m} THEN '{S.VIP}'
    WHEN {recency} < {loyal_r} AND {frequency} > {loyal_f} AND {monetary} > {loyal_m} THEN '{S.LOYAL}'
    WHEN {recency} < {new_r} THEN '{S.NEW}'
    WHEN {recency} > {inactive_r} THEN '{S.INACTIVE}'
    WHEN {monetary} > {high_m} THEN '{S.HIGH_VALUE}'
    ELSE {fallback} END"""


def _named(key: str, limits=_USUAL_LIMITS) -> str:
    name = _ladder(
        '"Recency_mean"',
        '"Frequency_mean"',
        '"Monetary_mean"',
        f"'{S.UNNAMED_PREFIX}' || CAST(\"{key}\" AS VARCHAR)",
        limits,
    )
    return f"""{_CUSTOMERS}{_profile(key)},
named AS (
  SELECT *, {name} AS "Segment_Name" FROM profile
)"""


def _description(rules: S.SegmentRules) -> str:
    texts = segment_descriptions(rules)
    return "CASE \"Segment_Name\"" + "".join(
        f" WHEN '{name}' THEN '{text}'" for name, text in texts.items() if name
    ) + f""" ELSE '{texts[None]}' END AS "Description\""""


_DESCRIPTION = _description(RULES)


def _recommended(named: str) -> str:
    return f"""WITH {named},
        actions(kind, rank, action) AS (VALUES
    {_ACTION_ROWS}),
        kinds AS (
          SELECT DISTINCT "Segment_Name",
                 CASE WHEN "Segment_Name" LIKE '%VIP%' THEN 'VIP'
                      WHEN "Segment_Name" LIKE '%Loyal%' THEN 'Loyal'
                      WHEN "Segment_Name" LIKE '%New%' THEN 'New'
                      WHEN "Segment_Name" LIKE '%Inactive%' THEN 'Inactive'
                      ELSE 'Other' END AS kind
          FROM named)
        SELECT "Segment_Name", CAST(rank AS INTEGER) AS rank, action
        FROM kinds JOIN actions ON kinds.kind = actions.kind"""


_ACTION_ROWS = ",\n    ".join(
    f"('{kind}', {rank}, '{action}')"
    for kind, listed in ACTIONS.items()
    for rank, action in enumerate(listed, 1)
)

_CURVE = f"""{_RFM},
curve_tiles AS (
  {" UNION ALL ".join(
      f'SELECT {k} AS k, {_tile("Recency", k)} AS tile, "Recency" AS r FROM rfm'
      for k in CURVE_KS
  )}
),
curve AS (
  SELECT k, round(sum(squares), 4) AS "WSSSE" FROM (
    SELECT k, tile,
           CAST(sum(CAST(r AS BIGINT) * r) AS DOUBLE)
             - CAST(sum(r) AS DOUBLE) * sum(r) / count(*) AS squares
    FROM curve_tiles GROUP BY k, tile)
  GROUP BY k
)"""

_RATIOS = f"""{_CURVE},
steps AS (
  SELECT k, "WSSSE" - lag("WSSSE") OVER (ORDER BY k) AS before,
         lead("WSSSE") OVER (ORDER BY k) - "WSSSE" AS after
  FROM curve
),
ratios AS (
  SELECT k, before / nullif(after, 0) AS ratio FROM steps
  WHERE before IS NOT NULL AND after IS NOT NULL
)"""


def _report(key: str) -> str:
    def fixed(column: str, places: int) -> str:
        value = f'CAST(CAST("{column}" AS DECIMAL(38, 5)) AS DECIMAL(38, {places}))'
        return f"CAST({value} AS VARCHAR)"

    return f"""WITH {_named(key)},
written AS (
  SELECT 1 AS position, 'Segments of ' || CAST(sum("CustomerID_count") AS VARCHAR)
         || ' customers as of 2024-05-06 07:08:09' AS value FROM named
  UNION ALL SELECT 2, 'Model: {S.KMEANS_NAME} with k = 4, mean silhouette 0.5000'
  UNION ALL SELECT 3, ''
  UNION ALL SELECT 4, concat_ws(chr(9), 'no.', 'segment', 'size', 'days since last invoice', 'invoices', 'value', 'revenue')
  UNION ALL
  SELECT 4 + row_number() OVER (ORDER BY "{key}"),
         concat_ws(chr(9), CAST("{key}" AS VARCHAR), "Segment_Name", CAST("CustomerID_count" AS VARCHAR),
                   {fixed("Recency_mean", 1)}, {fixed("Frequency_mean", 1)}, {fixed("Monetary_mean", 2)},
                   CAST(CAST(CAST("Monetary_mean" * "CustomerID_count" AS DECIMAL(38, 5)) AS DECIMAL(38, 0)) AS VARCHAR))
  FROM named
)
SELECT CAST(position AS INTEGER) AS position, value FROM written"""


def _axis(name: str, source: str, measure: str, bins: int = 50) -> str:
    """Equal bins over the values of a measure."""
    return f"""
{name}_span AS (
  SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
         CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi
  FROM (SELECT CAST(min("{measure}") AS DOUBLE) AS lo, CAST(max("{measure}") AS DOUBLE) AS hi
        FROM {source})
),
{name} AS (
  SELECT CAST(i AS INTEGER) AS bin, lo + i * ((hi - lo) / {bins}) AS bin_low,
         lo + (i + 1) * ((hi - lo) / {bins}) AS bin_high
  FROM {name}_span, range({bins}) AS t(i)
)"""


def _in_bin(name: str, value: str, bins: int = 50) -> str:
    return f"({value} >= {name}.bin_low AND ({value} < {name}.bin_high OR {name}.bin = {bins - 1}))"


def _cube(key: str, bins: int = 20) -> str:
    axes = {"x": "Recency", "y": "Frequency", "z": "Monetary"}
    spans = ",".join(_axis(f"{a}_axis", "customers", m, bins) for a, m in axes.items())
    joins = " ".join(f"""JOIN {a}_axis ON {_in_bin(f"{a}_axis", f'"{m}"', bins)}""" for a, m in axes.items())
    cells = ", ".join(f"{a}_axis.bin" for a in axes)
    named = ", ".join(f"{a}_axis.bin AS {a}_bin" for a in axes)
    return f"""WITH {_CUSTOMERS},{spans}
SELECT "{key}", {named}, count(*) AS customers FROM customers {joins} GROUP BY "{key}", {cells}"""


def _histogram(measure: str, condition: str) -> str:
    return f"""WITH {_RFM},
chosen AS (SELECT CAST("{measure}" AS DOUBLE) AS v, "{measure}" FROM rfm WHERE {condition}),
{_axis("axis", "chosen", measure)}
SELECT bin, {_half_up('bin_low', 4)} AS bin_low, {_half_up('bin_high', 4)} AS bin_high,
       count(v) AS customers
FROM axis LEFT JOIN chosen ON {_in_bin("axis", "v")}
GROUP BY bin, bin_low, bin_high"""


def _grid(x: str, y: str, mean_of: str, key: str | None = None) -> str:
    source, ctes = ("customers", _CUSTOMERS) if key else ("rfm", _RFM)
    keys = f'"{key}", ' if key else ""
    return f"""WITH {ctes},
{_axis("x_axis", source, x)},
{_axis("y_axis", source, y)}
SELECT {keys}x_axis.bin AS x_bin, y_axis.bin AS y_bin, count(*) AS customers,
       {_half_up(f'avg("{mean_of}")', 4)} AS "{mean_of}_mean"
FROM {source} JOIN x_axis ON {_in_bin("x_axis", f'"{x}"')}
     JOIN y_axis ON {_in_bin("y_axis", f'"{y}"')}
GROUP BY {keys}x_axis.bin, y_axis.bin"""


def _box(measure: str, key: str = '"R_Quartile"', name: str = "R_Quartile") -> str:
    return f"""WITH {_CUSTOMERS},
boxes AS (
  SELECT {key} AS g, quantile_cont("{measure}", 0.25) AS q1,
         quantile_cont("{measure}", 0.5) AS median, quantile_cont("{measure}", 0.75) AS q3
  FROM customers GROUP BY {key}
),
placed AS (
  SELECT g, q1, median, q3, CAST("{measure}" AS DOUBLE) AS v,
         "{measure}" BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM customers JOIN boxes ON {key} = g
)
SELECT g AS "{name}", count(*) AS customers, {_half_up('q1', 4)} AS q1,
       {_half_up('median', 4)} AS median, {_half_up('q3', 4)} AS q3,
       {_half_up("least(q1, min(v) FILTER (WHERE inside))", 4)} AS whisker_low,
       {_half_up("greatest(q3, max(v) FILTER (WHERE inside))", 4)} AS whisker_high,
       count(*) FILTER (WHERE NOT inside) AS outliers
FROM placed GROUP BY g, q1, median, q3"""


def _scaled(source: str) -> str:
    columns = ", ".join(
        f'("{m}" - avg("{m}") OVER ()) / stddev_samp("{m}") OVER () AS {m[0].lower()}'
        for m in S.MEASURES
    )
    return f'SELECT *, {columns} FROM {source} WHERE "Recency" IS NOT NULL'


def _silhouette(label: str) -> str:
    return f"""WITH {_CUSTOMERS},
points AS (SELECT "CustomerID" AS id, "{label}" AS c, r, f, m FROM ({_scaled("customers")})),
sums AS (
  SELECT c, count(*) AS n, sum(r) AS yr, sum(f) AS yf, sum(m) AS ym,
         sum(r * r + f * f + m * m) AS psi
  FROM points GROUP BY c
),
distances AS (
  SELECT id, points.c = sums.c AS own, n,
         r * r + f * f + m * m + psi / n - 2 * (r * yr + f * yf + m * ym) / n AS d
  FROM points CROSS JOIN sums
),
pairs AS (
  SELECT id, max(n) FILTER (WHERE own) AS n,
         max(d * n / nullif(n - 1, 0)) FILTER (WHERE own) AS a,
         min(d) FILTER (WHERE NOT own) AS b
  FROM distances GROUP BY id
)
SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM pairs"""

_CLEAN_COLUMNS = """"CustomerID", "InvoiceNo", "InvoiceDate", "Quantity", "UnitPrice",
  "TotalAmount\""""

_CLEAN_STATS = f"""WITH {_DIRTY_CLEANED}
        SELECT original_count, cleaned_count, original_count - cleaned_count AS removed_count,
               round(CASE WHEN original_count > 0
                          THEN CAST(cleaned_count AS DOUBLE) / original_count * 100
                          ELSE 0 END, 6) AS retention_rate,
               unknown_customer_count, bad_quantity_count, bad_price_count, bad_date_count
        FROM (SELECT count(*) AS original_count,
                     count(*) FILTER (WHERE "CustomerID" IS NULL) AS unknown_customer_count,
                     count(*) FILTER (WHERE "Quantity" <= 0) AS bad_quantity_count,
                     count(*) FILTER (WHERE "UnitPrice" <= 0) AS bad_price_count
              FROM lines),
             (SELECT count(*) AS cleaned_count,
                     count(*) FILTER (WHERE "InvoiceDate" IS NULL) AS bad_date_count
              FROM cleaned)"""

_CHARTED = ("hist_recency", "grid_rf", "grid_fm", "grid_rm")


def _job_counts() -> str:
    return f"""{_DIRTY_CUSTOMERS},
counts AS (
  SELECT (SELECT count(*) FROM lines) AS original_count, (SELECT count(*) FROM cleaned) AS cleaned_count,
         count(*) AS customers, CAST(sum("RFM_Score") AS BIGINT) AS score_sum,
         count("Recency") AS dated, count(*) FILTER (WHERE "Recency" IS NULL) AS undated
  FROM customers
)"""


def _job_customers() -> str:
    charted = ", ".join(
        f"CAST({'dated' if 'r' in name.split('_')[1] else 'customers'} AS BIGINT) AS {name}" for name in _CHARTED
    )
    return f"""WITH {_job_counts()}
SELECT original_count, cleaned_count, customers,
       (SELECT {_half_up('avg("Monetary")')} FROM customers) AS mean_value, score_sum, {charted},
       CAST((SELECT count(*) FROM customers WHERE "Frequency" < 100) AS BIGINT) AS hist_frequency,
       CAST((SELECT count(*) FROM customers
             WHERE "Monetary" < (SELECT quantile_cont("Monetary", 0.95) FROM customers)) AS BIGINT) AS hist_monetary,
       CAST(10 AS BIGINT) AS preview_rows,
       (SELECT strftime(max("InvoiceDate"), '%Y-%m-%d') FROM cleaned) AS snapshot_day
FROM counts"""


def _job_clusters() -> str:
    everyone = ("profiled", "impact_customers", "summary_customers", "sizes", "box_recency", "box_monetary",
                "cube_by_cluster", "grid_rf_by_cluster", "grid_fm_by_cluster", "grid_rm_by_cluster")
    return f"""WITH {_job_counts()}
SELECT dated AS segmented,
       (SELECT round(CAST(sum(CAST("Monetary" AS DECIMAL(18, 2))) AS DOUBLE), 2) FROM customers WHERE "Recency" IS NOT NULL) AS revenue,
       (SELECT CAST(sum("RFM_Score") AS BIGINT) FROM customers WHERE "Recency" IS NOT NULL) AS scores,
       CAST(4 AS BIGINT) AS clusters, CAST(4 AS BIGINT) AS numbers, undated AS unscaled_count,
       CAST(0 AS BIGINT) AS actions_missing, {", ".join(f"dated AS {name}" for name in everyone)}
FROM counts"""


def _job_full() -> str:
    return f"""WITH {_job_counts()}
SELECT original_count, cleaned_count, customers, score_sum, dated AS hist_recency, dated AS segmented,
       CAST(4 AS BIGINT) AS clusters, dated AS profiled, dated AS grid_rf_by_cluster, dated AS exported,
       CAST(8 AS BIGINT) AS report_lines, CAST(3 AS BIGINT) AS sweep_steps
FROM counts"""


_MEANS = ", ".join(f"""{_half_up(f'avg("{m}")', 4)} AS "{m}_mean\"""" for m in S.MEASURES)

ORACLE: dict[str, str] = {
    "transactions": """
        SELECT o_custkey AS "CustomerID", CAST(o_orderkey AS VARCHAR) AS "InvoiceNo",
               o_orderdate AS "InvoiceDate", l_quantity AS "Quantity",
               l_extendedprice / l_quantity AS "UnitPrice", n_name AS "Country"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             LEFT JOIN customer ON o_custkey = c_custkey
             LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "clean_rows": f"WITH {_DIRTY_CLEANED} SELECT {_CLEAN_COLUMNS} FROM cleaned",
    "clean_rows_csv": f"WITH {_DIRTY_CLEANED} SELECT {_CLEAN_COLUMNS} FROM cleaned",
    "csv_records": f"""WITH {_DIRTY_LINES}
        SELECT lines + broken AS record_count, lines AS line_count, broken AS corrupt_count
        FROM (SELECT count(*) AS lines FROM lines), (SELECT count(*) AS broken FROM supplier)""",
    "clean_rows_dated": f"""WITH {_DIRTY_CLEANED}
        SELECT {_CLEAN_COLUMNS} FROM cleaned WHERE "InvoiceDate" IS NOT NULL""",
    "clean_stats": _CLEAN_STATS,
    "clean_stats_from_lines": _CLEAN_STATS,
    "preview": f"""WITH {_DIRTY_CLEANED}
        SELECT {_CLEAN_COLUMNS} FROM (
          SELECT * FROM cleaned
          ORDER BY "CustomerID", "InvoiceNo", "InvoiceDate" NULLS FIRST, "Quantity",
                   cleaned."UnitPrice", "TotalAmount" LIMIT 10)""",
    "snapshot": f"""WITH {_DIRTY_CLEANED}
        SELECT max("InvoiceDate") AS snapshot_date FROM cleaned""",
    "rfm_base": f"WITH {_RFM} SELECT {_BASE_COLUMNS} FROM rfm",
    "rfm_from_lines": f"WITH {_RFM} SELECT {_BASE_COLUMNS} FROM rfm",
    "rfm_dirty": f"WITH {_DIRTY_CLEANED}{_MEASURES} SELECT {_BASE_COLUMNS} FROM rfm",
    "rfm_quartiles": f"""WITH {_CUSTOMERS}
        SELECT {_BASE_COLUMNS}, "R_Quartile", "F_Quartile", "M_Quartile", "RFM_Score"
        FROM customers""",
    "rfm_dirty_quartiles": f"""WITH {_DIRTY_CUSTOMERS}
        SELECT "CustomerID", "R_Quartile", "F_Quartile", "M_Quartile", "RFM_Score"
        FROM customers""",
    "undated_quartiles": f"""WITH {_CLEANED}{_UNDATED}{_TILES}
        SELECT "CustomerID", "Recency", "R_Quartile", "F_Quartile", "M_Quartile", "RFM_Score" FROM customers""",
    "customer_kpis": f"WITH {_RFM} SELECT count(*) AS customers, {_MEANS} FROM rfm",
    "score_projection": f"""WITH {_CUSTOMERS}
        SELECT "CustomerID", "Recency", "Frequency", "Monetary", "R_Quartile" AS prediction,
               "TotalTransactions", {_half_up('"AvgTransactionValue"', 6)} AS "AvgTransactionValue",
               "RFM_Score"
        FROM customers""",
    "profile_by_quartile": f"WITH {_CUSTOMERS}{_profile('R_Quartile')} SELECT * FROM profile",
    "profile_by_score": f"WITH {_CUSTOMERS}{_profile('RFM_Score')} SELECT * FROM profile",
    "group_sizes": f"""WITH {_CUSTOMERS}
        SELECT "R_Quartile", count(*) AS customers FROM customers GROUP BY "R_Quartile\"""",
    "group_means": f"""WITH {_CUSTOMERS}
        SELECT "R_Quartile", {_MEANS} FROM customers GROUP BY "R_Quartile\"""",
    "monetary_p95": f"""WITH {_RFM},
        bound AS (SELECT quantile_cont("Monetary", 0.95) AS p FROM rfm)
        SELECT {_half_up('max(p)', 4)} AS p95,
               count(*) FILTER (WHERE "Monetary" < p) AS customers_below
        FROM rfm, bound""",
    "approximate_quantiles": " UNION ALL ".join(
        f"SELECT '{m}' AS measure, CAST(49 AS BIGINT) AS probabilities, CAST(0 AS BIGINT) AS outside" for m in S.MEASURES
    ),
    "frequency_sketches": f"""WITH {_RFM}
        SELECT "CustomerID", "Recency", "Frequency", "Monetary", "TotalTransactions",
               1 AS estimate_near
        FROM rfm""",
    "vip_count": f"""WITH {_named("RFM_Score")}
        SELECT CAST(coalesce(sum("CustomerID_count")
                    FILTER (WHERE "Segment_Name" LIKE '%VIP%'), 0) AS BIGINT) AS vip_customers
        FROM named""",
    "revenue": f"""WITH {_CUSTOMERS}
        SELECT "R_Quartile",
               round({_half_up('avg("Monetary")')} * count(*), 2) AS estimated_revenue,
               round(sum("Monetary"), 2) AS exact_revenue
        FROM customers GROUP BY "R_Quartile\"""",
    "customer_total": f"WITH {_RFM} SELECT count(*) AS customers FROM rfm",
    "segment_groups": f"""WITH {_named("R_Quartile")}
        SELECT "R_Quartile", "CustomerID_count", "Segment_Name", {_DESCRIPTION} FROM named""",
    "segment_scores": f"""WITH {_named("RFM_Score")}
        SELECT "RFM_Score", "CustomerID_count", "Segment_Name", {_DESCRIPTION} FROM named""",
    "segment_customers": f"""WITH {_RFM}
        SELECT "CustomerID", "Recency", "Frequency", "Monetary",
               {_ladder('"Recency"', '"Frequency"', '"Monetary"', "'Regular'")} AS "Segment"
        FROM rfm""",
    "segment_lookup": f"""WITH {_named("RFM_Score")}
        SELECT "CustomerID", customers."RFM_Score", "Segment_Name" AS "Segment"
        FROM customers JOIN named ON customers."RFM_Score" = named."RFM_Score\"""",
    "recommendations": _recommended(_named("RFM_Score")),
    "recommend_all_kinds": _recommended(_named("RFM_Score", _ALL_LIMITS)),
    "segment_all_branches": f"""WITH {_named("RFM_Score", _ALL_LIMITS)}
        SELECT "RFM_Score", "CustomerID_count", "Segment_Name", {_description(ALL_BRANCHES)} FROM named""",
    "lookup_fallback": f"""WITH {_named("RFM_Score")}
        SELECT "CustomerID", customers."RFM_Score",
               CASE WHEN customers."RFM_Score" % 2 = 0 THEN "Segment_Name"
                    ELSE '{S.UNNAMED_PREFIX}' || CAST(customers."RFM_Score" AS VARCHAR) END AS "Segment"
        FROM customers JOIN named ON customers."RFM_Score" = named."RFM_Score\"""",
    "profile_order": f"""WITH {_named("RFM_Score")}
        SELECT "RFM_Score", CAST(row_number() OVER (ORDER BY "RFM_Score") AS INTEGER) AS position FROM named""",
    "report_text": _report("R_Quartile"),
    "export_read_back": f"""WITH {_CUSTOMERS}
        SELECT "CustomerID", "Recency", "Frequency", "Monetary", "TotalTransactions", "RFM_Score",
               {_ladder('"Recency"', '"Frequency"', '"Monetary"', "'Regular'")} AS "Segment",
               'CustomerID,Recency,Frequency,Monetary,TotalTransactions,RFM_Score,Segment' AS column_order
        FROM customers""",
    "impact_summary": f"""WITH {_named("RFM_Score")}
        SELECT CAST(sum("CustomerID_count") AS BIGINT) AS customers,
               CAST(coalesce(sum("CustomerID_count")
                    FILTER (WHERE "Segment_Name" LIKE '%VIP%'), 0) AS BIGINT) AS vip_customers,
               round(sum("Monetary_mean" * "CustomerID_count"), 2) AS revenue
        FROM named""",
    "segment_summary": f"""WITH {_named("R_Quartile")}
        SELECT "R_Quartile", "Segment_Name", "CustomerID_count" AS customers, "Recency_mean",
               "Frequency_mean", "Monetary_mean",
               round("Monetary_mean" * "CustomerID_count", 2) AS revenue
        FROM named""",
    "scaled_features": f"""WITH {_RFM}
        SELECT "CustomerID", round(r, 6) AS "Recency_scaled", round(f, 6) AS "Frequency_scaled",
               round(m, 6) AS "Monetary_scaled"
        FROM ({_scaled("rfm")})""",
    "silhouette_fixed": _silhouette("R_Quartile"),
    "model_choice": f"""WITH a AS ({_silhouette("R_Quartile")}), b AS ({_silhouette("M_Quartile")}),
        cases AS (
          SELECT 'as_is' AS "case", a.silhouette AS kmeans, b.silhouette AS mixture FROM a, b
          UNION ALL SELECT 'swapped', b.silhouette, a.silhouette FROM a, b
          UNION ALL SELECT 'tie', b.silhouette, b.silhouette FROM b)
        SELECT *, CASE WHEN kmeans > mixture THEN '{S.KMEANS_NAME}' ELSE '{S.MIXTURE_NAME}' END AS chosen FROM cases""",
    "kmeans_check": f"""WITH {_RFM}
        SELECT count(*) AS customers, CAST(0 AS BIGINT) AS not_nearest, CAST(0 AS BIGINT) AS cost_differing FROM rfm""",
    "mixture_check": """SELECT CAST(0 AS BIGINT) AS sums_off, CAST(0 AS BIGINT) AS not_most_probable,
        CAST(0 AS BIGINT) AS means_moved""",
    "sweep_check": f"""WITH {_RFM}
        SELECT CAST(k AS INTEGER) AS k, customers, 0 AS differing
        FROM (SELECT count(*) AS customers FROM rfm), range(2, 11) AS t(k)""",
    "labels_by_partitioning": f"""WITH {_RFM}
        SELECT model, customers, CAST(0 AS BIGINT) AS differing
        FROM (SELECT count(*) AS customers FROM rfm), (VALUES ('kmeans'), ('mixture')) AS t(model)""",
    "elbow_table": f"""WITH {_CURVE}
        SELECT k, "WSSSE",
               coalesce({_half_up('("WSSSE" / lag("WSSSE") OVER (ORDER BY k) - 1) * -100')}, 0)
                 AS "Reduction"
        FROM curve""",
    "elbow_ratio": f"WITH {_RATIOS} SELECT k, round(ratio, 6) AS ratio FROM ratios",
    "elbow_pick": f"""WITH {_RATIOS}
        SELECT k AS optimal_k FROM ratios WHERE ratio IS NOT NULL
        ORDER BY ratio DESC, k LIMIT 1""",
    "hist_recency": _histogram("Recency", "true"),
    "hist_frequency": _histogram("Frequency", '"Frequency" < 100'),
    "hist_monetary": _histogram(
        "Monetary", '"Monetary" < (SELECT quantile_cont("Monetary", 0.95) FROM rfm)'
    ),
    "grid_rf": _grid("Recency", "Frequency", "Monetary"),
    "grid_fm": _grid("Frequency", "Monetary", "Recency"),
    "grid_rm": _grid("Recency", "Monetary", "Frequency"),
    "hist_frequency_10": _histogram("Frequency", '"Frequency" < 10'),
    "grid_by_group": _grid("Recency", "Frequency", "Monetary", "R_Quartile"),
    "grid_fm_by_group": _grid("Frequency", "Monetary", "Recency", "R_Quartile"),
    "grid_rm_by_group": _grid("Recency", "Monetary", "Frequency", "R_Quartile"),
    "cube_by_group": _cube("R_Quartile"),
    "point_sample": f"""WITH {_CUSTOMERS},
        placed AS (
          SELECT "CustomerID", "Recency", "Frequency", "Monetary", "R_Quartile",
                 row_number() OVER (PARTITION BY "R_Quartile" ORDER BY md5('42:' || CAST("CustomerID" AS VARCHAR)), "CustomerID") AS place,
                 count(*) OVER (PARTITION BY "R_Quartile") AS group_customers
          FROM customers)
        SELECT * EXCLUDE (place) FROM placed WHERE place <= 100""",
    "job_customers": _job_customers(),
    "job_clusters": _job_clusters(),
    "job_full": _job_full(),
    "box_recency": _box("Recency"),
    "box_monetary": _box("Monetary"),
    "box_by_customer_group": _box("Monetary", '"CustomerID" % 150', "customer_group"),
    "tiles_100": f"""WITH {_RFM}
        SELECT "CustomerID", """
    + ", ".join(f'{_tile(m, 100)} AS "{m}_tile"' for m in S.MEASURES)
    + " FROM rfm",
}
