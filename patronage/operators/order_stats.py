"""Exact order statistics of large columns without sorting or moving the rows.

Finding "the row at rank r of a measure" needs no global sort. A first scan keeps one mergeable
quantile sketch per group and measure, which gives every rank a bracket: two values that the row
must lie between. A second scan counts exactly: rows between two brackets are only counted, rows
inside one are counted by value, and running sums over those few values find the value at each
rank. Where a border falls among equal values, a third scan ranks these by customer id; only if
more than `finish_rows` are equal, it takes a sketch of their ids first, and a fourth one ranks.

A bracket holds a fixed small share of the rows, and up to `finish_rows` rows everything lies in
one. A sketch errs only with some small probability, and counting shows it if it does: a rank
outside its bracket is looked for again between wider ones, so results are always exact. Each
row finds its bracket by binary search, so any number of ranks costs little.

The order is that of Spark: nulls, negative infinity, numbers, infinity, NaN.

Each scan must see the same rows, so `df` should be a staged table or derived from one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.staging import stage

#: Size of a sketch: its ranks are off by about 0.13 % of the rows in one of a hundred cases.
ACCURACY = 4096
FINISH_ROWS = 20_000
INFINITY = float("inf")


@dataclass(frozen=True)
class Extent:
    """How many rows a measure has, how many of them are null, and the bounds of its numbers."""

    rows: int
    nulls: int
    low: float | None
    high: float | None


def _is_whole(df: DataFrame, name: str) -> bool:
    return isinstance(
        df.schema[name].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
    )


def tie_break(df: DataFrame, id_column: str) -> str:
    """Whole-number ids order as they are, others by their hash."""
    return f"cast(`{id_column}` AS bigint)" if _is_whole(df, id_column) else f"xxhash64(`{id_column}`)"


def _finite(value: Column) -> Column:
    return F.when((value < INFINITY) & (value > -INFINITY), value)


def extents(df: DataFrame, measures: Iterable[str]) -> dict[str, Extent]:
    """Row count, null count and finite bounds of each measure, in one pass."""
    measures = list(measures)
    aggregates = [F.count("*").alias("rows")]
    for m in measures:
        value = F.col(m).cast("double")
        aggregates += [
            F.count(value).alias(f"{m}_count"),
            F.min(_finite(value)).alias(f"{m}_low"),
            F.max(_finite(value)).alias(f"{m}_high"),
        ]
    r = df.agg(*aggregates).first()
    return {
        m: Extent(r["rows"], r["rows"] - r[f"{m}_count"], r[f"{m}_low"], r[f"{m}_high"])
        for m in measures
    }


def place(value: Column) -> Column:
    """Where a value stands among the kinds of values: null, -inf, number, inf, NaN."""
    return (
        F.when(value.isNull(), 0)
        .when(F.isnan(value), 4)
        .when(value == INFINITY, 3)
        .when(value == -INFINITY, 1)
        .otherwise(2)
    )


def _slack(accuracy: int) -> float:
    """Share of rows on either side of a rank that its bracket takes in."""
    return 9.0 / accuracy


#: Tests that are compiled with the rest of a plan; more of them would outgrow a compiled method.
COMPILED_TESTS = 16


def _tree(tests: list[str]) -> str:
    if not tests:
        return "0"
    middle = len(tests) // 2
    later, earlier = _tree(tests[middle + 1 :]), _tree(tests[:middle])
    more = "" if later == "0" else f" + {later}"
    return f"(CASE WHEN {tests[middle]} THEN {middle + 1}{more} ELSE {earlier} END)"


def count_true(tests: list[Callable[..., str]], *operands: str) -> str:
    """SQL for how many of the tests hold, if each implies those before it: a binary search.

    A test makes SQL from the operands' SQL.
    """
    if len(tests) <= COMPILED_TESTS:
        return _tree([test(*operands) for test in tests])
    fields = [f"o{i}" for i in range(len(operands))]
    row = ", ".join(f"'{name}', {sql}" for name, sql in zip(fields, operands))
    searched = _tree([test(*(f"s.{name}" for name in fields)) for test in tests])
    return f"element_at(transform(array(named_struct({row})), s -> {searched}), 1)"


def _ordered_value(name: str, nulls: bool) -> str:
    """A measure as a double that orders alike; NaN counts as infinity, null as -infinity or as nothing."""
    value = f"cast(`{name}` AS double)"
    mapped = f"CASE WHEN isnan({value}) THEN double('Infinity') ELSE {value} END"
    return f"coalesce({mapped}, double('-Infinity'))" if nulls else mapped


def _bracketed(
    df: DataFrame,
    probabilities: Mapping[str, Iterable[float]],
    nulls: bool,
    group: str | None,
    accuracy: int,
    finish_rows: int,
    slack: float,
) -> DataFrame:
    """First scan: the bounds of each measure's brackets, two per rank, per group."""
    columns = []
    for m, ps in probabilities.items():
        x = _ordered_value(m, nulls)
        ends = [e for p in ps for e in (max(p - slack, 0.0), min(p + slack, 1.0))]
        listed = ", ".join(literal(e) for e in ends)
        everything = ", ".join(["double('-Infinity'), double('Infinity')"] * (len(ends) // 2))
        columns.append(
            F.expr(
                f"CASE WHEN count({x}) <= {finish_rows} THEN array({everything})"
                f" ELSE kll_sketch_get_quantile_double(kll_sketch_agg_double({x}, {accuracy}), array({listed})) END"
            ).alias(f"{m}_bounds")
        )
    keyed = df.withColumn("group_", F.col(group) if group else F.lit(0))
    return keyed.groupBy("group_").agg(*columns) if group else keyed.agg(*columns)


def _counted(df: DataFrame, brackets: DataFrame, probabilities: Mapping[str, list[float]], nulls: bool, group: str | None) -> DataFrame:
    """Second scan: (group, measure, zone, value, place, n), staged; even zones lie between brackets.

    Values and places are kept in the odd zones, which are the brackets.
    """
    if group:
        bounds = [F.col(f"{m}_bounds")[i].alias(f"{m}_{i}") for m, ps in probabilities.items() for i in range(2 * len(ps))]
        # One row per group; the planner decides by their size how to join.
        brackets = stage(brackets.select("group_", *bounds), "brackets")
        rows = df.join(brackets, F.col(group).eqNullSafe(F.col("group_")))
        bound = "`{0}_{1}`".format
    else:
        known = brackets.first()
        rows = df.withColumn("group_", F.lit(0))
        bound = lambda m, i: literal(known[f"{m}_bounds"][i])
    parts = []
    for m, ps in probabilities.items():
        x = _ordered_value(m, nulls)
        tests = []
        for i in range(len(ps)):
            low, high, last = bound(m, 2 * i), bound(m, 2 * i + 1), bound(m, 2 * i - 1) if i else None
            # brackets that overlap share no rows: the later one begins after the earlier one
            after = f" AND {{0}} > {last}" if last else ""
            tests += [f"({{0}} >= {low}{after})".format, f"{{0}} > {high}".format]
        zone = count_true(tests, x)
        parts.append(f"struct('{m}' AS measure, {zone} AS zone, {x} AS value, cast(`{m}` AS double) AS own)")
    long = rows.select("group_", F.expr(f"inline(array({', '.join(parts)}))")).where("value IS NOT NULL")
    inside = F.col("zone") % 2 == 1
    return stage(
        long.groupBy(
            F.col("group_").alias("group"),
            "measure",
            "zone",
            F.when(inside, F.col("value")).alias("value"),
            F.when(inside, place(F.col("own"))).alias("place"),
        ).agg(F.count("*").alias("n")),
        "counted",
    )


def _located(counted: DataFrame, ranks: DataFrame, order: list[str]) -> DataFrame:
    """`ranks` (group, measure, position, rank) with what lies there: `order`, `at` among `n` equal rows.

    `n` is null where a rank lies in no bracket.
    """
    keys = ["group", "measure"]
    in_order = Window.partitionBy(*keys).orderBy("zone")
    zones = counted.groupBy(*keys, "zone").agg(F.sum("n").alias("zone_rows"))
    zones = zones.withColumn("upto", F.sum("zone_rows").over(in_order))
    held = _joined(ranks, zones, keys, F.expr("upto - zone_rows < rank AND rank <= upto"), "inner")
    held = held.withColumn("rest", F.col("rank") - F.col("upto") + F.col("zone_rows")).drop("upto", "zone_rows")
    # Each bracket is summed on its own.
    by_value = Window.partitionBy(*keys, "zone").orderBy(*order)
    values = counted.where("zone % 2 = 1").withColumn("upto", F.sum("n").over(by_value))
    found = _joined(held, values, [*keys, "zone"], F.expr("upto - n < rest AND rest <= upto"), "left")
    return found.select(*keys, "rows", "position", "rank", *order, (F.col("rest") - F.col("upto") + F.col("n")).alias("at"), "n")


def _joined(left: DataFrame, right: DataFrame, keys: list[str], within: Column, how: str) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"{k}_r" for k in keys})
    test = within
    for k in keys:
        test = test & F.col(k).eqNullSafe(F.col(f"{k}_r"))
    return left.join(renamed, test, how).drop(*(f"{k}_r" for k in keys))


def values_at(
    df: DataFrame,
    positions: Mapping[str, Mapping[float, str]],
    *,
    nulls: bool,
    group: str | None = None,
    accuracy: int = ACCURACY,
    finish_rows: int = FINISH_ROWS,
) -> DataFrame:
    """(group, measure, position, rank, value, place, at, n): the row at each position, staged.

    `positions` maps a measure to the share of rows before a position and SQL, in terms of `rows`,
    for its rank, which counts from 1; a rank that is null or 0 is left out. `position` is the
    number of the position in that mapping. With `nulls` they come first, else they are no rows.
    `value` is at rank `at` of `n` equal ones; infinity stands for NaN where `place` says so, and
    negative infinity for null.
    """
    positions = {m: dict(sorted(own.items())) for m, own in positions.items()}
    shares = {m: list(own) for m, own in positions.items()}
    slack = _slack(accuracy)
    while True:
        brackets = _bracketed(df, shares, nulls, group, accuracy, finish_rows, slack)
        counted = _counted(df, brackets, shares, nulls, group)
        sizes = counted.groupBy("group", "measure").agg(F.sum("n").alias("rows"))
        listed = F.lit(None)
        for m, own in positions.items():
            structs = ", ".join(f"struct({i} AS position, cast({sql} AS bigint) AS rank)" for i, sql in enumerate(own.values()))
            listed = F.when(F.col("measure") == m, F.expr(f"array({structs})")).otherwise(listed)
        ranks = sizes.select("group", "measure", "rows", F.inline(listed)).where("rank > 0")
        found = stage(_located(counted, ranks, ["value", "place"]), "located")
        if slack >= 1 or not found.where("n IS NULL").limit(1).count():
            return found
        slack *= 16


def ids_at(
    df: DataFrame,
    ties: list[tuple[str, float, int, int, int]],
    *,
    id_column: str,
    accuracy: int = ACCURACY,
    finish_rows: int = FINISH_ROWS,
) -> dict[tuple[str, float, int, int], tuple]:
    """(tie, id) of the rows at rank `at` of the `n` rows of equal (measure, value, place).

    `ties` lists (measure, value, place, at, n); the result's keys are the first four.
    """
    if not ties:
        return {}
    spark = df.sparkSession
    classes = {key: number for number, key in enumerate(sorted({t[:3] for t in ties}))}
    listed = spark.createDataFrame(
        [(*key, number) for key, number in classes.items()], "measure string, value_c double, place_c int, class int"
    )
    measures = sorted({t[0] for t in ties})
    parts = ", ".join(
        f"struct('{m}' AS measure_r, {_ordered_value(m, True)} AS value, cast(`{m}` AS double) AS own)" for m in measures
    )
    rows = df.select(
        F.expr(tie_break(df, id_column)).alias("tie"), F.col(id_column).alias("id"), F.expr(f"inline(array({parts}))")
    )
    # One row per border that the caller asks for.
    test = (F.col("measure") == F.col("measure_r")) & (F.col("value") == F.col("value_c")) & (place(F.col("own")) == F.col("place_c"))
    rows = rows.join(F.broadcast(listed), test).select("class", "tie", "id")
    low, high = {}, {}
    large = [t for t in ties if t[4] > finish_rows]
    if large:
        slack = _slack(accuracy)
        columns = [
            F.expr(
                f"kll_sketch_get_quantile_bigint(kll_sketch_agg_bigint(tie, {accuracy}) FILTER (WHERE class = {classes[t[:3]]}),"
                f" array({literal(max(t[3] / t[4] - slack, 0.0))}, {literal(min(t[3] / t[4] + slack, 1.0))}))"
            ).alias(f"b{i}")
            for i, t in enumerate(large)
        ]
        bounds = rows.agg(*columns).first()
        for i, t in enumerate(large):
            low[t], high[t] = bounds[f"b{i}"]
    found = {}
    left = list(ties)
    while left:
        brackets = [(i, classes[t[:3]], low.get(t, -(2**63)), high.get(t, 2**63 - 1), t[3]) for i, t in enumerate(left)]
        sought = spark.createDataFrame(brackets, "border int, class_b int, low long, high long, at long")
        near = rows.join(F.broadcast(sought), F.expr("class = class_b AND tie <= high"))
        inside = F.expr("tie >= low")
        ranked = near.groupBy(
            "border", "at", inside.alias("inside"), F.when(inside, F.col("tie")).alias("tie"), F.when(inside, F.col("id")).alias("id")
        ).agg(F.count("*").alias("n"))
        order = Window.partitionBy("border").orderBy("inside", "tie", "id")
        ranked = ranked.withColumn("upto", F.sum("n").over(order))
        for r in ranked.where("inside AND upto - n < at AND at <= upto").collect():
            found[left[r["border"]][:4]] = (r["tie"], r["id"])
        # a sketch that erred gives way to the whole class
        left = [t for t in left if t[:4] not in found]
        low, high = {}, {}
    return found


def literal(value) -> str:
    """SQL text of a number or text, exact."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return f"{value}L"
    if isinstance(value, float):
        return f"double('{value!r}')"
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def is_above(value: float | None, tie: int | None, id=None) -> Callable[[str, str, str], str]:
    """A test, never null, of whether a row's value, tie-break and id come after these three.

    Without `tie` the row must come after all rows of that value; an id that is not text settles
    equal tie-breaks by itself.
    """

    def test(own: str, own_tie: str, own_id: str) -> str:
        if tie is None:
            return f"({own} IS NOT NULL)" if value is None else f"coalesce({own} > {literal(value)}, false)"
        later = f"{own_tie} > {literal(tie)}"
        if isinstance(id, str):
            later = f"({later} OR ({own_tie} = {literal(tie)} AND {own_id} > {literal(id)}))"
        if value is None:
            return f"({own} IS NOT NULL OR {later})"
        at = literal(value)
        return f"coalesce({own} > {at} OR ({own} = {at} AND {later}), false)"

    return test


def quantiles(
    df: DataFrame,
    measure_probabilities: Mapping[str, Iterable[float]],
    *,
    group: str | None = None,
    accuracy: int = ACCURACY,
    finish_rows: int = FINISH_ROWS,
) -> DataFrame:
    """(group, measure, probability, value): exact quantiles by linear interpolation.

    Nulls are ignored; a group without other rows has no quantile. `group` is 0 without groups.
    """
    wanted = {m: sorted({float(p) for p in ps}) for m, ps in measure_probabilities.items()}
    # Both rows that a quantile lies between are in its bracket, a hair apart.
    positions = {
        m: {
            share: rank
            for p in ps
            for share, rank in (
                (p, f"floor((rows - 1) * {literal(p)}) + 1"),
                (p + 1e-9, f"least(floor((rows - 1) * {literal(p)}) + 2, rows)"),
            )
        }
        for m, ps in wanted.items()
    }
    found = values_at(df, positions, nulls=False, group=group, accuracy=accuracy, finish_rows=finish_rows)
    value = F.when(F.col("place") == 4, double_nan()).otherwise(F.col("value"))
    number = F.floor(F.col("position") / 2)
    ends = found.groupBy("group", "measure", number.alias("number")).agg(
        F.max(F.when(F.col("position") % 2 == 0, value)).alias("lower"),
        F.max(F.when(F.col("position") % 2 == 1, value)).alias("upper"),
        F.min("rank").alias("rank"),
    )
    listed = df.sparkSession.createDataFrame(
        [(m, i, p) for m, ps in wanted.items() for i, p in enumerate(ps)], "measure string, number long, probability double"
    )
    # At most as many rows as probabilities were asked for.
    ends = ends.join(F.broadcast(listed), ["measure", "number"])
    sizes = found.groupBy("group", "measure").agg(F.max("rows").alias("rows"))
    ends = _joined(ends, sizes, ["group", "measure"], F.lit(True), "inner")
    position = (F.col("rows") - 1) * F.col("probability")
    between = F.col("lower") + (F.col("upper") - F.col("lower")) * (position - F.floor(position))
    value = F.when(F.col("lower") == F.col("upper"), F.col("lower")).otherwise(between)
    return ends.select("group", "measure", "probability", value.alias("value"))


def double_nan() -> Column:
    return F.lit(float("nan"))
