"""Exact quantiles of groups of any size, by one plan.

Equal values of a group are counted first. Every value belongs to a slice, a
fixed function of the value that never falls as it rises; the counts of a
group's slices give the rank at which each slice starts, and only inside a slice
are values ranked one by one. So neither a large group nor a common value meets
in one task, the plan is the same at every size, and nothing runs before an
action. Infinite values take part, values that are not numbers do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Slices of a power of two; only the spread of the work depends on it.
SLICES = 4096
# Beyond the exponents of doubles, so that every slice of a number above zero is positive.
_EXPONENTS = 1100
# Ranks that are looked up together.
_RANKS = 64


def _slice(x: Column) -> Column:
    """The place of a value on a scale with ``SLICES`` steps per power of two."""
    size = F.abs(x)
    power = F.least(F.floor(F.log2(size)), F.lit(1023))
    step = power * SLICES + F.floor((size / F.pow(F.lit(2.0), power) - 1) * SLICES) + _EXPONENTS * SLICES
    beyond = F.lit(2 * _EXPONENTS * SLICES)
    place = F.when(x == 0, F.lit(0)).when(size == float("inf"), beyond).otherwise(step).cast("long")
    return F.when(x < 0, -place).otherwise(place)


def _before(n: str, window) -> Column:
    """Sum of ``n`` over the rows before this one."""
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(earlier), F.lit(0))


def _ranked(rows: DataFrame) -> DataFrame:
    """``_g, _part, _x`` counted (``_c``), with the first rank of each count and the group's size ``_n``."""
    items = rows.groupBy("_g", "_part", "_x").agg(F.count("*").alias("_c")).withColumn("_slice", _slice(F.col("_x")))
    slices = items.groupBy("_g", "_slice").agg(F.sum("_c").alias("_s"))
    group = Window.partitionBy("_g")
    starts = slices.select(
        "_g", "_slice", _before("_s", group.orderBy("_slice")).alias("_start"), F.sum("_s").over(group).alias("_n")
    )
    inside = Window.partitionBy("_g", "_slice").orderBy("_x", "_part")
    ranked = items.withColumn("_rank", _before("_c", inside)).join(starts, ["_g", "_slice"])
    return ranked.withColumn("_rank", F.col("_start") + F.col("_rank")).drop("_start")


def _position(q: float, n: Column) -> Column:
    return F.lit(float(q)) * (n - 1)


def _between(low: Column, high: Column, position: Column) -> Column:
    """Linear between the two ranks; equal ends give their value, infinite ones too."""
    fraction = position - F.floor(position)
    return F.when((low == high) | (fraction == 0), low).otherwise(low + (high - low) * fraction)


def group_quantiles(df: DataFrame, keys: list[str], value: str, q: float) -> DataFrame:
    """``keys, quantile``: one exact quantile per group, linear between ranks."""
    return exact_quantiles(df, keys, value, [q], ["quantile"])


def listed_quantiles(df: DataFrame, keys: list[str], value: str, q: float) -> DataFrame:
    """As ``group_quantiles``, from the sorted values of a group: for groups that one task may hold."""
    x = F.col(value).cast("double") + F.lit(0.0)
    rows = df.select(*keys, x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    listed = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("_x")).alias("_xs"))
    position = _position(q, F.size("_xs"))
    low, high = (F.get("_xs", end(position).cast("int")) for end in (F.floor, F.ceil))
    return listed.select(*keys, _between(low, high, position).alias("quantile"))


def global_quantiles(df: DataFrame, value: str, qs: list[float], names: list[str]) -> DataFrame:
    """One row: exact quantiles of a whole column."""
    return exact_quantiles(df, [], value, qs, names)


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, qs: list[float], names: list[str], leave_out: str | None = None
) -> DataFrame:
    """Exact quantiles per group; a null key is a key of its own.

    With ``leave_out`` the result has one row per group and value of that
    column: the quantile of the group's rows that do *not* have the value.
    Groups left empty give no row.
    """
    x = F.col(value).cast("double") + F.lit(0.0)  # one zero
    part = F.col(leave_out) if leave_out else F.lit(None).cast("string")
    key = F.struct(F.lit(0).alias("_all"), *keys)
    rows = df.select(key.alias("_g"), part.alias("_part"), x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    ranked = _ranked(rows)
    if leave_out:
        out = _left_out(ranked, qs, names).withColumnRenamed("_part", leave_out)
    else:
        out = _plain(ranked, qs, names)
    kept = [F.col("_g").getField(k).alias(k) for k in keys]
    return out.select(*kept, *([leave_out] if leave_out else []), *names)


def _plain(ranked: DataFrame, qs: list[float], names: list[str]) -> DataFrame:
    """The values at the wanted ranks of every group."""

    def at(rank: Column) -> Column:
        here = (F.col("_rank") <= rank) & (rank < F.col("_rank") + F.col("_c"))
        return F.max(F.when(here, F.col("_x")))

    picked = []
    for q, name in zip(qs, names):
        position = _position(q, F.col("_n"))
        picked += [at(F.floor(position)).alias(f"_low_{name}"), at(F.ceil(position)).alias(f"_high_{name}")]
    found = ranked.groupBy("_g", "_n").agg(*picked)
    ends = [_between(F.col(f"_low_{n}"), F.col(f"_high_{n}"), _position(q, F.col("_n"))).alias(n) for q, n in zip(qs, names)]
    return found.select("_g", *ends)


def _left_out(ranked: DataFrame, qs: list[float], names: list[str]) -> DataFrame:
    """Quantiles of each group without each of its parts, from the ranks in the whole group.

    The r-th of the others stands at rank r plus the number of own rows that
    have at most r others before them. So a part needs one sum over its own rows
    and one look at the value of a rank, however many parts there are.
    """
    own = ranked.where(F.col("_part").isNotNull())
    slices = own.groupBy("_g", "_part", "_slice").agg(F.sum("_c").alias("_s"))
    part = Window.partitionBy("_g", "_part")
    starts = slices.select(
        "_g", "_part", "_slice", _before("_s", part.orderBy("_slice")).alias("_start"), F.sum("_s").over(part).alias("_own")
    )
    inside = Window.partitionBy("_g", "_part", "_slice").orderBy("_x")
    own = own.withColumn("_mine", _before("_c", inside)).join(starts, ["_g", "_part", "_slice"])
    others_before = F.col("_rank") - F.col("_start") - F.col("_mine")
    rest = F.col("_n") - F.col("_own")
    sums, sides = [], []
    for i, q in enumerate(qs):
        position = _position(q, rest)
        for side, rank in (("low", F.floor(position)), ("high", F.ceil(position))):
            passed = F.coalesce(F.sum(F.when(others_before <= rank, F.col("_c"))), F.lit(0))
            sums.append(passed.alias(f"_{side}{i}"))
            sides.append(F.struct(F.lit(i).alias("_q"), F.lit(side).alias("_side"), (rank + F.col(f"_{side}{i}")).alias("_wanted")))
    targets = own.where(rest > 0).groupBy("_g", "_part", "_n", "_own").agg(*sums)
    targets = targets.select("_g", "_part", rest.alias("_rest"), F.inline(F.array(*sides)))
    targets = targets.withColumn("_block", F.floor(F.col("_wanted") / _RANKS))
    last = F.col("_rank") + F.col("_c") - 1
    blocks = F.sequence(F.floor(F.col("_rank") / _RANKS), F.floor(last / _RANKS))
    values = ranked.select("_g", "_x", F.col("_rank").alias("_first"), last.alias("_last"), F.explode(blocks).alias("_block"))
    found = targets.join(values, ["_g", "_block"]).where(F.col("_wanted").between(F.col("_first"), F.col("_last")))

    def at(i: int, side: str) -> Column:
        return F.max(F.when((F.col("_q") == i) & (F.col("_side") == side), F.col("_x")))

    ends = [_between(at(i, "low"), at(i, "high"), _position(q, F.first("_rest"))).alias(n) for i, (q, n) in enumerate(zip(qs, names))]
    return found.groupBy("_g", "_part").agg(*ends)
