"""Seeded order and samples, stratified split, latitude folds."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderfield.contract import TARGET
from cinderfield.functions.scalars import hash_text
from cinderfield.operators.ordered import exact_quantiles, running_sums
from cinderfield.scratch import settle


def seeded_order(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Reproducible shuffle: a range-partitioned sort by keyed hash, then key."""
    return df.orderBy(hash_text(F.col(key), seed), F.col(key))


def bounded_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """At most ``n`` rows without replacement, the same rows on every run."""
    return seeded_order(df, key, seed).limit(n)


def ranked(ordered: DataFrame) -> DataFrame:
    """Add ``place``: 1, 2, 3 ... in the order of a sorted table.

    Settled once, since the place of a row is its number in its own partition plus
    the sizes of the partitions before; those few sizes are all that meets in one task.
    """
    low = F.shiftright(F.monotonically_increasing_id(), 33).cast("int")
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = settle(ordered.select("*", low.alias("_part"), within.alias("_row")), "ordered")
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_ahead"))
    return numbered.join(offsets, "_part").withColumn("place", F.col("_ahead") + F.col("_row") + 1).drop("_part", "_row", "_ahead")


def first_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(order).limit(n)


def class_of(y: Column) -> Column:
    """1, 0 or null: at most three groups, whatever the label column holds."""
    return F.when(y == 1, 1).when(y == 0, 0)


#: Digits of a hash.
HASH_DIGITS = 32
#: Hash digits that one round of the selection looks at, and rows of a bin that are simply sorted.
DIGITS = 3
BIN_ROWS = 10_000


@dataclass(frozen=True)
class _Wanted:
    """The row of rank ``rank`` among the class's hashes that begin with ``prefix``."""

    cls: int | None
    name: str
    prefix: str
    rank: int


def _nth_hashes(slim: DataFrame, wanted: list[_Wanted], bin_rows: int) -> dict[tuple[int | None, str], str]:
    """The wanted hashes, found digit by digit.

    Each round counts the rows of the bins still open by their next digits and goes
    on in the bin that holds the rank, until a bin is small or all its digits are
    used. The driver holds a prefix and a rank for each wanted hash, no more.
    """
    found: dict[tuple[int | None, str], str] = {}
    while wanted:
        size = len(wanted[0].prefix)
        open_ = reduce(lambda a, b: a | b, [F.col("_cls").eqNullSafe(w.cls) & F.col("_h").startswith(w.prefix) for w in wanted])
        digits = F.substring("_h", 1, size + DIGITS).alias("_digits")
        counts: dict[tuple[int | None, str], list[tuple[str, int]]] = {}
        for r in slim.filter(open_).groupBy("_cls", digits).agg(F.count(F.lit(1)).alias("n")).orderBy("_digits").collect():
            counts.setdefault((r["_cls"], r["_digits"][:size]), []).append((r["_digits"], r["n"]))
        small, further = [], []
        for w in wanted:
            before = 0
            for prefix, n in counts[w.cls, w.prefix]:
                if before + n >= w.rank:
                    here = _Wanted(w.cls, w.name, prefix, w.rank - before)
                    if len(prefix) >= HASH_DIGITS:
                        found[w.cls, w.name] = prefix
                    else:
                        (small if n <= bin_rows else further).append(here)
                    break
                before += n
        if small:
            here = reduce(lambda a, b: a | b, [F.col("_cls").eqNullSafe(w.cls) & F.col("_h").startswith(w.prefix) for w in small])
            ordered = F.sort_array(F.collect_list("_h"))  # bin_rows at most
            bins = slim.filter(here).groupBy("_cls", F.substring("_h", 1, len(small[0].prefix)).alias("_digits")).agg(ordered.alias("_all"))
            picks = bins.select("_cls", "_digits", *[F.get("_all", F.lit(w.rank - 1)).alias(f"_{i}") for i, w in enumerate(small)]).collect()
            for r in picks:
                found |= {(w.cls, w.name): r[f"_{i}"] for i, w in enumerate(small) if (w.cls, w.prefix) == (r["_cls"], r["_digits"])}
        wanted = further
    return found


def stratified_split(
    df: DataFrame,
    key: str,
    y: str,
    test: float = 0.2,
    val: float = 0.2,
    seed: int = 42,
    bin_rows: int = BIN_ROWS,
) -> DataFrame:
    """``df`` plus ``split``: per class the first ceil(test*n) rows in hash order are
    ``test``, the next ceil(val*n) ``val``, the rest ``train``. ``key`` is unique.

    Only two hash values per class are needed. They are selected digit by digit
    from the classes and hashes, which are written once; the wide rows are then
    labelled in place, without a shuffle, sort or join.
    """
    h = hash_text(F.col(key), seed)
    slim = settle(df.select(class_of(F.col(y)).alias("_cls"), h.alias("_h")), "hashes", "zstd")
    wanted = []
    for r in slim.groupBy("_cls").agg(F.count(F.lit(1)).alias("n")).collect():  # three classes at most
        n_test = math.ceil(r["n"] * test - 1e-9)
        n_val = n_test + math.ceil(r["n"] * val - 1e-9)
        wanted += [_Wanted(r["_cls"], name, "", k) for name, k in (("test", n_test), ("val", n_val)) if 0 < k <= r["n"]]
    cuts = _nth_hashes(slim, wanted, bin_rows)
    split = F.lit("train")
    for name in ("val", "test"):
        limit = F.lit(None).cast("string")
        for (cls, part), cut in cuts.items():
            if part == name:
                limit = F.when(class_of(F.col(y)).eqNullSafe(cls), F.lit(cut)).otherwise(limit)
        split = F.when(h <= limit, F.lit(name)).otherwise(split)
    return df.select(*df.columns, split.alias("split"))


def fold_plan(df: DataFrame, k: int = 5, y: str = TARGET) -> DataFrame:
    """One row ``k_requested, n_rows, n_pos, k_planned``.

    ``k`` is lowered until there are five positives per fold, but not below 2.
    """
    k = max(2, int(k))
    n_pos = F.sum(F.when(F.col(y) == 1, 1).otherwise(0))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(n_pos, F.lit(0)).cast("long").alias("n_pos"),
    ).select(
        F.lit(k).alias("k_requested"),
        "n_rows",
        "n_pos",
        F.greatest(F.lit(2), F.least(F.lit(k), F.floor(F.col("n_pos") / 5)))
        .cast("int")
        .alias("k_planned"),
    )


def latitude_bands(df: DataFrame, k: int, lat: str = "lat", out: str = "fold") -> DataFrame:
    """``df`` plus a band number: ``k`` equal-count latitude bands, right-closed.

    Equal edges are merged; with one distinct latitude there is no band and the
    column is null, as it is for a null latitude. The ``k + 1`` edges are read
    first, so that labelling the rows is a plain projection.
    """
    edges = sorted(set(exact_quantiles(df, lat, [i / k for i in range(k + 1)])))
    if len(edges) < 2:
        return df.withColumn(out, F.lit(None).cast("int"))
    band = F.lit(0)
    for edge in edges[1:-1]:
        band = band + F.when(F.col(lat) > edge, 1).otherwise(0)
    return df.withColumn(out, F.when(F.col(lat).isNotNull(), band).cast("int"))


def rank_bands(df: DataFrame, k: int, lat: str, key: str, out: str = "fold") -> DataFrame:
    """Fallback bands by rank, ties broken by ``key``: exactly even however tied the latitudes.

    Ranks within one latitude use the key's hash bins, so a latitude shared by
    very many rows is not sorted in one task.
    """
    h = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 3), 16, 10).cast("int")
    work = df.withColumn("_hb", h)
    sizes = settle(work.groupBy(lat, "_hb").agg(F.count(F.lit(1)).alias("_n")), "sizes")
    per_lat = sizes.groupBy(lat).agg(F.sum("_n").alias("_m"))
    starts = running_sums(per_lat.withColumn("_v", F.col(lat).cast("double")), "_v", ["_m"])
    starts = starts.select(
        F.col(lat).alias("_slat"), (F.col("run__m") - F.col("_m")).alias("_before"), "tot__m"
    )
    inner = Window.partitionBy(lat).orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    bins = sizes.withColumn("_ahead", F.coalesce(F.sum("_n").over(inner), F.lit(0)))
    offsets = bins.join(starts, F.col(lat) == F.col("_slat")).select(
        "_slat", F.col("_hb").alias("_shb"), (F.col("_before") + F.col("_ahead")).alias("_off"), "tot__m"
    )
    joined = work.join(offsets, (F.col(lat) == F.col("_slat")) & (F.col("_hb") == F.col("_shb")), "left")
    rank = F.col("_off") + F.row_number().over(Window.partitionBy(lat, "_hb").orderBy(key))
    band = (F.ceil(rank * k / F.col("tot__m")) - 1).cast("int")
    return joined.withColumn(out, band).select(*df.columns, out)


def spatial_folds(df: DataFrame, k: int = 5, lat: str = "lat", y: str = TARGET) -> DataFrame:
    """``df`` plus ``fold``: latitude bands, ``k`` lowered by ``fold_plan`` (one row is read)."""
    for column in (lat, y):
        if column not in df.columns:
            raise ValueError(f"spatial folds need column {column}")
    planned = fold_plan(df, k, y).first()["k_planned"]
    return latitude_bands(df, planned, lat)


def training_rows(folded: DataFrame, fold: int) -> DataFrame:
    """Everything outside the fold; rows without a band train in every fold."""
    return folded.filter(~F.col("fold").eqNullSafe(F.lit(fold)))


def validation_rows(folded: DataFrame, fold: int) -> DataFrame:
    return folded.filter(F.col("fold") == fold)


def fold_summary(folded: DataFrame, y: str = TARGET) -> DataFrame:
    """Per fold: validation and training sizes, positives, and whether both sides hold both classes."""
    pos = F.sum(F.when(F.col(y) == 1, 1).otherwise(0))
    # One row per fold; the null fold (rows without a band) stays in the totals.
    per = folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n_val"), pos.alias("pos_val"))
    everything = Window.partitionBy()
    full = per.withColumns(
        {"_n": F.sum("n_val").over(everything), "_p": F.sum("pos_val").over(everything)}
    )
    n_train, pos_train = F.col("_n") - F.col("n_val"), F.col("_p") - F.col("pos_val")
    both = (
        (F.col("pos_val") > 0)
        & (F.col("pos_val") < F.col("n_val"))
        & (pos_train > 0)
        & (pos_train < n_train)
    )
    return full.filter(F.col("fold").isNotNull()).select(
        "fold",
        "n_val",
        "pos_val",
        n_train.alias("n_train"),
        pos_train.alias("pos_train"),
        both.cast("int").alias("usable"),
        (F.col("pos_val") < 5).cast("int").alias("few_positives"),
    )
