"""Tiles over the whole customer table, without a single-partition window."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage import schema as S
from patronage.operators.order_stats import (
    ACCURACY,
    FINISH_ROWS,
    count_true,
    ids_at,
    is_above,
    tie_break,
    values_at,
)


def last_ranks(rows: int, tiles: int) -> list[int]:
    """Rank of the last row of every tile but the last, as `ntile` sizes them."""
    size, extra = divmod(rows, tiles)
    return [i * size + min(i, extra) for i in range(1, tiles)]


def _rank(tile: int, tiles: int) -> str:
    """SQL of `last_ranks`, in terms of `rows`."""
    return f"{tile} * (rows div {tiles}) + least({tile}, rows % {tiles})"


def tile_columns(
    df: DataFrame,
    wanted: Iterable[tuple[str, int]],
    *,
    id_column: str = "CustomerID",
    accuracy: int = ACCURACY,
    finish_rows: int = FINISH_ROWS,
) -> dict[tuple[str, int], Column]:
    """`ntile(n)` over (measure ascending nulls first, id) for each wanted (measure, n).

    Only the rows at the tile borders are looked up, all in the same scans; a tile number is
    then found by binary search among them, so the rows themselves never move. The driver
    gets the n - 1 borders that the caller asks for.
    """
    wanted = list(wanted)
    positions: dict[str, dict[float, str]] = {}
    for measure, tiles in wanted:
        own = positions.setdefault(measure, {})
        # equal shares of different tilings may have different ranks
        own.update({i / tiles + 1e-9 * tiles: _rank(i, tiles) for i in range(1, tiles)})
    positions = {m: dict(sorted(own.items())) for m, own in positions.items() if own}
    limits = {"accuracy": accuracy, "finish_rows": finish_rows}
    found = values_at(df, positions, nulls=True, **limits).collect() if positions else []
    at = {(r["measure"], list(positions[r["measure"]].values())[r["position"]]): r for r in found}
    inner = {(m, r["value"], r["place"], r["at"], r["n"]) for (m, _), r in at.items() if r["at"] < r["n"]}
    ids = ids_at(df, sorted(inner), id_column=id_column, **limits)
    columns: dict[tuple[str, int], Column] = {}
    for measure, tiles in wanted:
        tests = []
        for i in range(1, tiles):
            r = at.get((measure, _rank(i, tiles)))
            if r is None:
                # Without rows up to a border every row lies above it.
                tests.append(lambda *_: "true")
                continue
            value = {0: None, 4: float("nan")}.get(r["place"], r["value"])
            tie = ids.get((measure, r["value"], r["place"], r["at"]), (None, None))
            tests.append(is_above(value, *tie))
        operands = (f"cast(`{measure}` AS double)", tie_break(df, id_column), f"`{id_column}`")
        columns[measure, tiles] = F.expr(f"1 + {count_true(tests, *operands)}")
    return columns


def quartiles(rfm: DataFrame, *, measures: Iterable[str] = S.MEASURES, **limits: int) -> DataFrame:
    """Add the quartile of each measure and the combined score; columns are named after the measure.

    Recency ranks ascending, so `R_Quartile` 1 is the most recent, while 4 is the best for
    `F_Quartile` and `M_Quartile`. Ties are decided by CustomerID. With fewer `measures` only
    their quartiles are looked for, and there is no score.
    """
    measures = list(measures)
    tiles = tile_columns(rfm, [(m, 4) for m in measures], **limits)
    scored = rfm.withColumns({f"{m[0]}_Quartile": tiles[m, 4] for m in measures})
    if set(measures) != set(S.MEASURES):
        return scored
    score = F.col("R_Quartile") * 100 + F.col("F_Quartile") * 10 + F.col("M_Quartile")
    return scored.withColumn("RFM_Score", score)
