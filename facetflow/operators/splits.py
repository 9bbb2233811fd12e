"""Training splits: whole vendors per fold, and the latest fifth by date."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Number of folds, share of the training part, smallest usable parts.
MAX_FOLDS = 5
TRAIN_SHARE = 0.8
MIN_DATED_ROWS = 100
MIN_LATE_ROWS = 20
MIN_VENDOR_TRAIN_ROWS = 50
MIN_VENDOR_TEST_ROWS = 10

UNKNOWN_VENDOR = "Unknown"
_COPIES_PER_TASK = 1_000_000


def vendor_group(vendor: Column) -> Column:
    return F.coalesce(vendor, F.lit(UNKNOWN_VENDOR))


def group_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct(vendor_group(F.col("vendor"))).alias("n_groups"))


def dealing_order(loads: list[int], size: int) -> list[tuple[int, list[int]]]:
    """How items of one size go to the lightest fold, one after the other.

    A list of ``(first, folds)``: from item ``first`` on, the items go round
    ``folds``. An item makes a fold heavier by ``size``, so fold f is the lightest
    at the weights ``loads[f]``, ``loads[f] + size``, ...; ordered by weight (ties:
    the smaller fold) these are levels of ``size``, and a fold takes part in all
    levels from its own on.
    """
    order = sorted(range(len(loads)), key=lambda f: loads[f] // size)
    out, first, level = [], 0, loads[order[0]] // size
    for active in range(1, len(loads) + 1):
        if active < len(loads) and loads[order[active]] // size == level:
            continue
        out.append((first, sorted(order[:active], key=lambda f: (loads[f] % size, f))))
        if active < len(loads):
            to = loads[order[active]] // size
            first, level = first + active * (to - level), to
    return out


def _after(loads: list[int], size: int, items: int) -> list[int]:
    """The loads after dealing out ``items`` of one size."""
    out, stages = list(loads), dealing_order(loads, size)
    for (first, folds), (end, _) in zip(stages, [*stages[1:], (items, [])]):
        dealt = max(min(end, items) - first, 0)
        for k, fold in enumerate(folds):
            out[fold] += size * ((dealt - k + len(folds) - 1) // len(folds))
    return out


def vendor_folds(df: DataFrame, max_folds: int = MAX_FOLDS) -> DataFrame:
    """``vendor, fold``: largest vendors first (ties by name), each to the lightest fold.

    The driver sees how many vendors there are of every size, no vendor: vendors
    of one size go round the folds in an order that follows from the loads
    before them, so a vendor's fold follows from its rank inside its size.
    """
    sizes = df.groupBy(vendor_group(F.col("vendor")).alias("vendor")).agg(F.count("*").alias("_size"))
    loads, dealt = [0] * max_folds, []
    for row in sizes.groupBy("_size").agg(F.count("*").alias("n")).orderBy(F.desc("_size")).toLocalIterator():
        dealt.append((row["_size"], dealing_order(loads, row["_size"])))
        loads = _after(loads, row["_size"], row["n"])
    orders = df.sparkSession.createDataFrame(dealt, "_size long, _order array<struct<first:long,folds:array<int>>>")
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.partitionBy("_size").orderBy("vendor")) - 1)
    now = F.element_at(F.filter("_order", lambda s: s["first"] <= F.col("_rank")), -1)
    place = F.pmod(F.col("_rank") - F.col("_now.first"), F.size("_now.folds")).cast("int")
    met = ranked.join(orders, "_size").withColumn("_now", now)
    return met.select("vendor", F.get("_now.folds", place).alias("fold"))


@dataclass(frozen=True)
class TimeCut:
    """Where the later part starts.

    Rows of ``date`` count as late if their order text is at or above
    ``order``; of the identical rows that equal it, the first ``early_copies``
    are still early.
    """

    date: object
    order: str
    early_copies: int
    early_rows: int
    late_rows: int


def order_text(df: DataFrame, tie: list[str]) -> Column:
    """Fixed-length text that orders rows of one date the same way on any cluster.

    First by a digest of the tie columns, then by one of the whole row, so only
    identical rows are equal.
    """

    keys = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in tie])
    return F.concat(F.md5(keys), F.md5(F.to_json(F.struct(*df.columns))))


def time_cut(
    df: DataFrame,
    tie: list[str],
    train_share: float = TRAIN_SHARE,
    min_rows: int = MIN_DATED_ROWS,
    min_late: int = MIN_LATE_ROWS,
) -> TimeCut | None:
    """Split point after exactly ``int(rows * train_share)`` dated rows, or None.

    Rows are counted per date; only the date the cut falls on is looked into.
    There the cut is found digit by digit over the order text, each step one
    count of at most 65,536 prefixes, so no date is ever gathered or sorted.
    """
    dated = df.where(F.col("date_seen").isNotNull())
    days = dated.groupBy("date_seen").count().orderBy("date_seen").collect()
    total = sum(d["count"] for d in days)
    early = int(total * train_share)
    if total < min_rows or total - early < min_late:
        return None
    before = 0
    for day in days:
        if before + day["count"] > early:
            break
        before += day["count"]
    wanted = early - before
    if wanted == 0:
        return TimeCut(day["date_seen"], "", 0, early, total - early)

    inside = dated.where(F.col("date_seen") == F.lit(day["date_seen"])).select(
        order_text(df, tie).alias("_order")
    )
    prefix, length, step = "", 64, 4
    while len(prefix) < length:
        slot = F.substring("_order", 1, len(prefix) + step)
        counts = (
            inside.where(F.startswith("_order", F.lit(prefix)))
            .groupBy(slot.alias("_slot"))
            .count()
            .orderBy("_slot")
            .collect()
        )
        for row in counts:
            if row["count"] > wanted:
                break
            wanted -= row["count"]
        prefix = row["_slot"]
        if wanted == 0:
            break
    return TimeCut(day["date_seen"], prefix, wanted, early, total - early)


def with_time_split(df: DataFrame, cut: TimeCut, tie: list[str]) -> DataFrame:
    """Add ``is_late``: false, true, or null for rows without a date."""
    on_date = F.col("date_seen") == F.lit(cut.date)
    order = order_text(df, tie)
    late = F.when(on_date, order >= cut.order).otherwise(F.col("date_seen") > F.lit(cut.date))
    if not cut.early_copies:
        return df.withColumn("is_late", late)

    same = F.coalesce(on_date & (order == cut.order), F.lit(False))
    rest = df.where(~same).withColumn("is_late", late)
    return rest.unionByName(_split_copies(df.where(same), cut.early_copies))


def _split_copies(copies: DataFrame, early_copies: int) -> DataFrame:
    """Identical rows, the given number of them early: counted, then dealt out again."""
    columns = copies.columns
    counted = copies.groupBy(*columns).agg(F.count("*").alias("_n"))
    pieces = F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / _COPIES_PER_TASK))
    dealt = counted.withColumn("_piece", F.explode(pieces)).repartition("_piece")
    start = F.col("_piece") * _COPIES_PER_TASK
    stop = F.least(start + _COPIES_PER_TASK, F.col("_n")) - 1
    each = dealt.withColumn("_copy", F.explode(F.sequence(start, stop)))
    return each.select(*columns, (F.col("_copy") >= early_copies).alias("is_late"))
