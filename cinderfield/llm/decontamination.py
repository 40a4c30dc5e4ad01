"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only (operator 8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderfield.llm import words as W
from cinderfield.scratch import settle

WINDOW = 13
SHINGLE = 3


def item_words(text: Column) -> Column:
    """Runs of a-z, 0-9 and non-ASCII characters after A-Z are lower-cased."""
    return W.split_words(F.translate(text, W.UPPER, W.LOWER), W.NOT_ITEM_WORD)


def windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows of the items: (window, n, items), the window's words joined by blanks.

    Items without id give windows too; ``items`` lists the others.
    """
    rows = items.select(F.col(id_col).cast("string").alias("item"), item_words(F.col(text_col)).alias("words"))
    size = F.least(F.lit(WINDOW), F.size("words"))
    starts = W.positions(F.size("words") - size + 1)
    rows = rows.where(F.size("words") > 0).select(
        "item", size.alias("n"), F.explode(F.transform(starts, lambda i: F.array_join(F.slice("words", i + 1, size), " "))).alias("window")
    )
    return rows.groupBy("window", "n").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _tokens(words: Column, sizes: list[int]) -> Column:
    """Shingle hashes with place and size; sizes below SHINGLE serve items of one or two words only."""
    def of(size: int) -> Column:
        return F.transform(W.shingles(words, size), lambda h, i: F.struct(h.alias("token"), i.alias("at"), F.lit(size).alias("k")))

    return F.concat(*map(of, sizes))


def annotate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Columns (row, n_words, n_hit, items, contaminated): each input row whole, with what was found in it.

    A window is 13 consecutive words of an item, or all words of a shorter one; a
    document word inside any occurrence of a window is hit. A document is
    contaminated if it has hits and they are a twentieth of its words or more.

    A window contained in a document has all its shingles there, in order, so its
    rarest one suffices as the join prefix: shingles of the benchmark are looked
    up in all documents in one pass, counted, and each window keeps the one seen
    least (of equal ones the smallest hash). Where that shingle stands, the
    window's start follows; starts that leave the document's bounds go, and the
    rest are verified word by word over the item-sized window.

    Only places of benchmark shingles leave the pass over the documents; they are
    written to shared scratch once. The window table has no fixed size and no
    broadcast hint; Spark broadcasts it only if its measured size is small. A
    passage in a third of all documents spreads over the documents' own keys.

    Documents without words, and null ones, have no hit. Items without words
    are ignored; those without id give hits but are not listed in ``items``. Equal
    windows of several items count for each of them. Repeated
    documents each give their row, whatever their columns are called.
    """
    found = settle(windows(benchmark, item_col, item_text_col), "windows")
    sizes = sorted(r["n"] for r in found.select(F.least("n", F.lit(SHINGLE)).alias("n")).distinct().collect())  # three at most
    key = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"), F.col(text_col).alias("text"))
    if not sizes:
        none = F.array().cast("array<string>")
        rows = rows.withColumn("n_words", F.size(item_words(F.col("text"))).cast("long"))
        return rows.select("row", "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("items"), F.lit(False).alias("contaminated"))

    prefix_size = F.least("n", F.lit(SHINGLE))
    spots = found.select("*", F.split("window", " ").alias("words")).select(
        "window", "n", "items", F.explode(F.filter(_tokens(F.col("words"), sizes), lambda t: t["k"] == prefix_size)).alias("t")
    )
    spots = spots.select("window", "n", "items", "t.token", F.col("t.at").alias("offset"), "t.k")
    wanted = settle(spots.select("token", "k").distinct(), "tokens")
    worded = rows.select("key", item_words(F.col("text")).alias("words"))
    places = worded.select("key", F.size("words").alias("size"), F.explode(_tokens(F.col("words"), sizes)).alias("t"))
    places = settle(
        places.select("key", "size", "t.token", "t.at", "t.k").join(wanted, ["token", "k"], "left_semi"), "places"
    )
    seen = places.groupBy("token", "k").agg(F.count(F.lit(1)).alias("seen"))
    # A shingle that no document has rules its window out at once: inner join, then the rarest.
    rarest = (
        spots.join(seen, ["token", "k"], "left")
        .groupBy("window", "n")
        .agg(
            F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "token", "offset", "k")).alias("prefix"),
            F.first("items").alias("items"),
        )
        .where(F.col("prefix.seen") > 0)
        .select("window", "n", "items", "prefix.token", "prefix.offset", "prefix.k")
    )
    start = F.col("at") - F.col("offset")
    candidates = (
        places.join(settle(rarest, "prefixes"), ["token", "k"])
        .where((start >= 0) & (start + F.col("n") <= F.col("size")))
        .groupBy("key")
        .agg(F.collect_set(F.struct(start.alias("start"), "n", "window", "items")).alias("candidates"))
    )
    joined = rows.join(candidates, "key", "left")
    joined = joined.select("row", "candidates", item_words(F.col("text")).alias("words"))
    true = F.filter("candidates", lambda c: F.array_join(F.slice("words", c["start"] + 1, c["n"]), " ") == c["window"])
    none = F.array().cast("array<struct<start: int, n: int, window: string, items: array<string>>>")
    joined = joined.select("row", F.size("words").cast("long").alias("n_words"), F.coalesce(true, none).alias("true"))
    joined = joined.select("*", F.sort_array(F.transform("true", lambda c: F.struct(c["start"], (c["start"] + c["n"]).alias("end")))).alias("spans"))
    hit = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["end"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["start"]))).alias("n"),
        ),
        lambda a: a["n"].cast("long"),
    )
    joined = joined.select(
        "row", "n_words", hit.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.transform("true", lambda c: c["items"])))).alias("items")
    )
    return joined.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def clean(docs: DataFrame, benchmark: DataFrame, **columns: str) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    kept = annotate(docs, benchmark, **columns).where(~F.col("contaminated"))
    return kept.select("row.*")
