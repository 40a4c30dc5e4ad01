"""Exact order statistics over a whole table without a single-task sort.

Spark runs a window without partition keys in one task. Here the distinct keys are
written once and dealt into value ranges of bounded size, as many as there are keys
for; each range's total gives the next its starting offset, in two levels, and the
rest of the running sum stays inside a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderfield.scratch import settle

#: Keys of one range: what a task sorts.
ROWS_PER_RANGE = 50_000
#: Ranges whose totals are summed together in one task.
RANGES_PER_BLOCK = 1_000


def _ranges(df: DataFrame, key: str, rows_per_range: int) -> DataFrame:
    """``df``, written once, plus ``_range``: a rising number of the value range a row's key lies in."""
    keys = settle(df, "keys")
    ranges = -(-keys.count() // rows_per_range)
    if ranges < 2:
        return keys.withColumn("_range", F.lit(0))
    return settle(keys.repartitionByRange(ranges, F.col(key)).withColumn("_range", F.spark_partition_id()), "ranges")


def _offsets(totals: DataFrame, by: list[str], sums: list[str], descending: bool) -> DataFrame:
    """Per group and range: what lies ahead of it, and the group's total; blocks of ranges first, ranges inside a block second."""
    order = F.desc if descending else F.asc
    blocked = totals.withColumn("_block", F.floor(F.col("_range") / RANGES_PER_BLOCK))
    blocks = blocked.groupBy(*by, "_block").agg(*[F.sum(f"_s_{c}").alias(f"_s_{c}") for c in sums])
    group = Window.partitionBy(*by)
    before = group.orderBy(order("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        *[F.col(b).alias(f"_o_{b}") for b in by],
        F.col("_block").alias("_o_block"),
        *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_ahead_{c}") for c in sums],
        *[F.sum(f"_s_{c}").over(group).alias(f"tot_{c}") for c in sums],
    )
    match = F.col("_block") == F.col("_o_block")
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"_o_{b}"))
    inside = Window.partitionBy(*by, "_block").orderBy(order("_range")).rowsBetween(Window.unboundedPreceding, -1)
    local = blocked.withColumns({f"_l_{c}": F.coalesce(F.sum(f"_s_{c}").over(inside), F.lit(0)) for c in sums})
    return local.join(blocks, match).select(
        *[F.col(b).alias(f"_b_{b}") for b in by],
        F.col("_range").alias("_b_range"),
        *[(F.col(f"_l_{c}") + F.col(f"_ahead_{c}")).alias(f"_off_{c}") for c in sums],
        *[f"tot_{c}" for c in sums],
    )


def running_sums(
    df: DataFrame,
    key: str,
    sums: list[str],
    by: list[str] | None = None,
    descending: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``run_<c>`` (inclusive running sum in key order) and ``tot_<c>`` per column.

    ``key`` is a double, distinct within ``by``, which should have few values (folds,
    rounds). ``df`` is run once and written; the number of ranges follows its rows.
    """
    by = by or []
    cut = _ranges(df, key, rows_per_range)
    order = F.desc if descending else F.asc
    totals = cut.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_s_{c}") for c in sums])
    offsets = _offsets(totals, by, sums, descending)
    match = F.col("_range") == F.col("_b_range")
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"_b_{b}"))
    inside = (
        Window.partitionBy(*by, "_range")
        .orderBy(order(key))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = cut.join(offsets, match)
    return joined.select(
        *df.columns,
        *[(F.sum(c).over(inside) + F.col(f"_off_{c}")).alias(f"run_{c}") for c in sums],
        *[f"tot_{c}" for c in sums],
    )


def quantile_row(df: DataFrame, value: str, probabilities: list[float]) -> DataFrame:
    """One row ``q ARRAY<DOUBLE>``: exact quantiles with linear interpolation, nulls skipped.

    Works on distinct values and their counts, so neither ties nor row count
    reach one task.
    """
    # Null and NaN weigh nothing instead of being filtered: a filter would be pushed
    # below and repeat the whole expression behind ``value``.
    real = F.when(F.col("_v") <= F.lit(float("inf")), 1)
    counts = (
        df.select(F.col(value).cast("double").alias("_v")).groupBy("_v").agg(F.count(real).alias("_c"))
    )
    ranked = running_sums(counts, "_v", ["_c"])

    def at(position: Column) -> Column:
        holds = (F.col("run__c") > position) & (F.col("run__c") - F.col("_c") <= position)
        return F.max(F.when(holds, F.col("_v")))

    places = [(F.col("tot__c") - 1) * F.lit(float(q)) for q in probabilities]
    picked = ranked.agg(
        F.max("tot__c").alias("n"),
        F.array(*[at(F.floor(h)) for h in places]).alias("low"),
        F.array(*[at(F.ceil(h)) for h in places]).alias("high"),
    )
    quantiles = []
    for i, q in enumerate(probabilities):
        h = (F.col("n") - 1) * F.lit(float(q))
        low, high = F.col("low")[i], F.col("high")[i]
        quantiles.append(low + (high - low) * (h - F.floor(h)))
    return picked.select(F.array(*quantiles).alias("q"))


def exact_quantiles(df: DataFrame, value: str, probabilities: list[float]) -> list[float]:
    """The same as a list: one number per probability; empty when there is no value."""
    return [v for v in quantile_row(df, value, probabilities).first()["q"] if v is not None]
