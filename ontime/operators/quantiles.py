"""Percentiles per group: exact, approximate, or from mergeable sketches.

The exact routes start from a histogram, one row per (group, value) with a
count. Building it combines on the map side and shuffles by group *and*
value, so a group that holds a third of all rows is spread like any other.
Ranks are then located by refining cells: values are counted in cells of a
fixed relative width, and only the cells that hold a wanted rank are split
further, each between its own least and largest value, round by round, until
a cell holds one value. Small whole numbers have a cell each and need no
further round; points in time of one day share a cell at first and need one or
two. A task sees the cells of a group, the parts of a cell or the few values
of a small cell, but never all values of a group, however dense they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ontime import schema as S
from ontime.functions import percentile_fields
from ontime.operators.reuse import stored

# The reported percentiles.
QUARTILES_AND_P90 = (0.25, 0.5, 0.75, 0.9)
QUARTILES_AND_P90_NAMES = ("p25", "p50", "p75", "p90")

# Cells between a value and its double in the first round; parts of a cell in
# later rounds; distinct values of a cell that are ordered without splitting it.
CELLS_PER_OCTAVE = 4096
PARTS = 65_536
FEW_VALUES = 10_000
# The most cells, some 100 bytes each, that are broadcast, after counting them.
BROADCAST_CELLS = 100_000

# Cells of NaN, which Spark sorts last, and of the infinities. Doubles span less
# than 1100 octaves to either side of 1, so shifting by so many keeps cells of
# one sign together.
_LAST_CELL = 2**63 - 1
_OCTAVES = 1100


def value_histogram(
    df: DataFrame, keys: Sequence[str], value: str = S.DEP_DELAY, count: str = "n"
) -> DataFrame:
    """Rows per (group, value). Nulls keep a row, so that no group gets lost."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(count))


def merge_histogram(
    histogram: DataFrame, keys: Sequence[str], value: str = S.DEP_DELAY, count: str = "n"
) -> DataFrame:
    """The histogram of coarser groups: histograms are mergeable states, too."""
    return histogram.groupBy(*keys, value).agg(F.sum(count).alias(count))


def percentiles_from_histogram(
    histogram: DataFrame,
    keys: Sequence[str],
    value: str = S.DEP_DELAY,
    probs: Sequence[float] = QUARTILES_AND_P90,
    names: Sequence[str] = QUARTILES_AND_P90_NAMES,
    interpolate: bool = False,
    count: str = "n",
) -> DataFrame:
    """Exact percentiles of every group of a histogram, computed by the call.

    The histogram may be finer than the groups: several rows may count the
    same value. Ranks are 1-based and come from decimal arithmetic. A discrete
    percentile needs one rank; an interpolated one the ranks below and above
    its position.
    """
    ranks, fields = [], []
    for prob, name in zip(probs, names, strict=True):
        p = Decimal(str(prob))
        if interpolate:
            low, high = _value_at(len(ranks)), _value_at(len(ranks) + 1)
            ranks += [
                f"CAST(floor({p} * (_total - 1)) AS BIGINT) + 1",
                f"CAST(ceil({p} * (_total - 1)) AS BIGINT) + 1",
            ]
            position = f"{p} * (max(_total) - 1)"
            part = f"CAST({position} - floor({position}) AS DOUBLE)"
            fields.append(F.expr(f"{low} + ({high} - {low}) * {part}").alias(name))
        else:
            fields.append(F.expr(_value_at(len(ranks))).alias(name))
            ranks.append(f"greatest(CAST(ceil({p} * _total) AS BIGINT), 1)")

    by = [*map(_quoted, keys)]
    values = _celled(histogram, by, value, count)
    targets, still_open = _located(_first_targets(values, by, ranks))
    found = [*by, "_total", "_rank_no", "_low"]
    settled = targets.where(_SETTLED).select(*found)
    rows = None
    while still_open:
        rest = targets.where(f"NOT ({_SETTLED})")
        if rows is None:
            place, inside = [*keys, "_cell"], values
        else:
            place, inside = ["_id", "_part", "_exact"], _parted(rows)
        # The ranks of one cell have its bounds in common.
        cells = rest.select(*map(_quoted, place), "_low", "_high", "_rows").distinct()
        cells = stored(cells.withColumn("_new", F.monotonically_increasing_id()), "cells")
        rows = stored(_rows_of(inside, cells, place), "cell-values")
        wanted = rest.join(_renamed(cells, place), _same(rest, place)).select(
            *by, "_total", "_rank_no", F.col("_rank").alias("_wanted"), F.col("_new").alias("_id")
        )
        targets, still_open = _located(_next_targets(rows, wanted))
        settled = settled.unionByName(targets.where(_SETTLED).select(*found))
    return settled.groupBy(*by).agg(*fields)


# A target is settled once its cell holds one value only, or none.
_SETTLED = "_low <=> _high"


def _located(targets: DataFrame) -> tuple[DataFrame, int]:
    """The targets, stored, and how many are not settled, counted on the way."""
    seen = Observation()
    watched = targets.observe(seen, F.count_if(F.expr(f"NOT ({_SETTLED})")).alias("open"))
    return stored(watched, "ranks"), seen.get["open"]


def _value_at(rank_no: int) -> str:
    return f"max(CASE WHEN _rank_no = {rank_no} THEN _low END)"


def _cell(x: str) -> str:
    """Cell number of a double: the logarithm of its size, cut to whole steps.

    Cells come in the order of the values.
    """
    return (
        f"CASE WHEN isnan({x}) THEN {_LAST_CELL} WHEN {x} = 0 THEN 0 "
        f"WHEN abs({x}) = double('infinity') THEN CAST(sign({x}) AS BIGINT) * {_LAST_CELL - 1} "
        f"ELSE CAST(sign({x}) AS BIGINT) * "
        f"({_OCTAVES * CELLS_PER_OCTAVE} + floor({CELLS_PER_OCTAVE} * log2(abs({x})))) END"
    )


def _celled(histogram: DataFrame, by: Sequence[Column], value: str, count: str) -> DataFrame:
    held = F.when(_quoted(value).isNull(), 0).otherwise(_quoted(count))
    cell = F.expr(_cell(f"CAST(`{value}` AS DOUBLE)"))
    return histogram.select(*by, _quoted(value).alias("_value"), held.alias("_n"), cell.alias("_cell"))


def _cell_columns() -> list[Column]:
    return [
        F.sum("_n").alias("_n"),
        F.count(F.lit(1)).alias("_rows"),
        F.min("_value").alias("_low"),
        F.max("_value").alias("_high"),
    ]


def _first_targets(values: DataFrame, by: Sequence[Column], ranks: Sequence[str]) -> DataFrame:
    """Each group's wanted ranks: the cell that holds it, and the rank in there."""
    group = Window.partitionBy(*by)
    cells = (
        values.groupBy(*by, "_cell")
        .agg(*_cell_columns())
        .withColumn("_upto", F.sum("_n").over(group.orderBy("_cell")))
        .withColumn("_total", F.sum("_n").over(group))
    )
    wanted = F.posexplode(F.array(*map(F.expr, ranks))).alias("_rank_no", "_wanted")
    held = (F.col("_wanted") > F.col("_upto") - F.col("_n")) & (F.col("_wanted") <= F.col("_upto"))
    # A group without values keeps a row.
    none = (F.col("_total") == 0) & (F.col("_rank_no") == 0)
    return (
        cells.select("*", wanted)
        .where(held | none)
        .withColumn("_rank", F.col("_wanted") - (F.col("_upto") - F.col("_n")))
        .select(*by, "_total", "_rank_no", "_rank", "_cell", "_low", "_high", "_rows")
    )


def _parted(rows: DataFrame) -> DataFrame:
    """Values with the part of their cell: an equal share of the cell's range, or
    the value itself where there are few or no double lies between."""
    x, low, high = (F.col(c).cast("double") for c in ("_value", "_low", "_high"))
    wide = (high > low) & (F.col("_rows") > FEW_VALUES)
    share = F.least(F.floor((x - low) / (high - low) * PARTS), F.lit(PARTS - 1))
    return rows.withColumns(
        {
            "_part": F.when(wide, share).otherwise(0).cast("long"),
            "_exact": F.when(~wide, F.col("_value")),
        }
    )


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _renamed(cells: DataFrame, place: Sequence[str]) -> DataFrame:
    return cells.select(
        *[_quoted(c).alias(f"_at_{c}") for c in place],
        "_new",
        *[F.col(c).alias(f"_of{c}") for c in ("_low", "_high", "_rows")],
    )


def _same(df: DataFrame, place: Sequence[str]) -> Column:
    return reduce(and_, [df[f"`{c}`"].eqNullSafe(_quoted(f"_at_{c}")) for c in place])


def _rows_of(inside: DataFrame, cells: DataFrame, place: Sequence[str]) -> DataFrame:
    """The values of the given cells. A cell may hold most of a group: where the
    cells are few they are broadcast, so that its values stay spread."""
    found = _renamed(cells, place)
    if cells.count() <= BROADCAST_CELLS:
        found = F.broadcast(found)
    return inside.join(found, _same(inside, place)).select(
        F.col("_new").alias("_id"),
        "_value",
        "_n",
        *[F.col(f"_of{c}").alias(c) for c in ("_low", "_high", "_rows")],
    )


def _next_targets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The ranks of cells that were split, located in their parts."""
    order = Window.partitionBy("_id").orderBy("_part", "_exact")
    parts = (
        _parted(rows)
        .groupBy("_id", "_part", "_exact")
        .agg(*_cell_columns())
        .withColumn("_upto", F.sum("_n").over(order))
        .withColumn("_before", F.col("_upto") - F.col("_n"))
    )
    held = (F.col("_wanted") > F.col("_before")) & (F.col("_wanted") <= F.col("_upto"))
    return (
        parts.join(wanted, "_id")
        .where(held)
        .withColumn("_rank", F.col("_wanted") - F.col("_before"))
        .drop("_n", "_upto", "_before", "_wanted")
    )


def percentiles_discrete(
    df: DataFrame,
    keys: Sequence[str],
    value: str = S.DEP_DELAY,
    probs: Sequence[float] = QUARTILES_AND_P90,
    names: Sequence[str] = QUARTILES_AND_P90_NAMES,
) -> DataFrame:
    """Exact percentiles that are values of the data."""
    return percentiles_from_histogram(
        value_histogram(df, keys, value), keys, value, probs, names, False
    )


def percentiles_interpolated(
    df: DataFrame,
    keys: Sequence[str],
    value: str = S.DEP_DELAY,
    probs: Sequence[float] = QUARTILES_AND_P90,
    names: Sequence[str] = QUARTILES_AND_P90_NAMES,
) -> DataFrame:
    """Exact percentiles, linearly interpolated between neighbouring values."""
    return percentiles_from_histogram(
        value_histogram(df, keys, value), keys, value, probs, names, True
    )


def percentiles_approx(
    df: DataFrame,
    keys: Sequence[str],
    value: str = S.DEP_DELAY,
    probs: Sequence[float] = QUARTILES_AND_P90,
    names: Sequence[str] = QUARTILES_AND_P90_NAMES,
    accuracy: int = 100,
) -> DataFrame:
    """Percentiles with a rank error of at most 1/accuracy, in one pass."""
    return (
        df.groupBy(*keys)
        .agg(F.percentile_approx(value, list(probs), accuracy).alias("_quantiles"))
        .select(*keys, *percentile_fields("_quantiles", names))
    )


# Size of a sketch: the rank error falls with it, the stored bytes grow.
SKETCH_K = 200


def sketch_column(value: str, k: int = SKETCH_K) -> Column:
    return F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch")


def merged_sketch_column(k: int = SKETCH_K) -> Column:
    return F.kll_merge_agg_double("sketch", k).alias("sketch")


def quantile_sketch(
    df: DataFrame, keys: Sequence[str], value: str = S.DEP_DELAY, k: int = SKETCH_K
) -> DataFrame:
    """One KLL sketch per group; nulls are not counted."""
    return df.groupBy(*keys).agg(sketch_column(value, k))


def merge_sketch(sketches: DataFrame, keys: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    return sketches.groupBy(*keys).agg(merged_sketch_column(k))


def read_sketch(
    sketches: DataFrame,
    keys: Sequence[str],
    probs: Sequence[float] = QUARTILES_AND_P90,
    names: Sequence[str] = QUARTILES_AND_P90_NAMES,
) -> DataFrame:
    """Number of values and the percentiles of each sketch; NULL for empty ones."""
    n = F.kll_sketch_get_n_double("sketch")
    quantiles = F.when(
        n > 0,
        F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(p) for p in probs])),
    )
    return sketches.select(*keys, n.alias("n"), *percentile_fields(quantiles, names))


def rank_error(
    histogram: DataFrame,
    estimates: DataFrame,
    keys: Sequence[str],
    value: str = S.DEP_DELAY,
    probs: Sequence[float] = QUARTILES_AND_P90,
    names: Sequence[str] = QUARTILES_AND_P90_NAMES,
    count: str = "n",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Largest distance per group between a wanted rank and an estimate's rank, in [0, 1].

    An estimate that occurs in the data covers the whole run of its equals.
    `present` is the number of non-null values of the group; `carry` names
    columns of the estimates to hand on.
    """
    named = estimates.select(
        *[F.col(k).alias(f"_estimate_{k}") for k in keys],
        *[F.col(name).alias(f"_estimate_{name}") for name in names],
        *[F.col(c).alias(f"_carried_{c}") for c in carry],
    )
    same_group = reduce(
        and_, [F.col(k).eqNullSafe(F.col(f"_estimate_{k}")) for k in keys], F.lit(True)
    )
    total = F.sum(count)
    errors = []
    for prob, name in zip(probs, names, strict=True):
        estimate = F.col(f"_estimate_{name}")
        below = F.sum(F.when(F.col(value) < estimate, F.col(count)).otherwise(0)) / total
        upto = F.sum(F.when(F.col(value) <= estimate, F.col(count)).otherwise(0)) / total
        errors.append(F.greatest(below - prob, prob - upto, F.lit(0.0)))
    return (
        histogram.filter(F.col(value).isNotNull())
        .join(named, same_group)
        .groupBy(*keys, *[F.col(f"_carried_{c}").alias(c) for c in carry])
        .agg(total.alias("present"), F.greatest(*errors, F.lit(0.0)).alias("rank_error"))
    )
