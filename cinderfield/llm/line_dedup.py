"""Removal of lines that spread over many sites (operator 4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderfield.llm import words as W
from cinderfield.scratch import settle

MIN_SITES = 8
LONG_WORDS = 50  # a line of more words is a passage
LONG_SITES = 3
SKETCH_BITS = 12
MARGIN = 0.1  # six standard errors of a sketch of 4,096 registers


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _line_key(line: Column) -> Column:
    """Hash of a line without outer blanks."""
    return F.xxhash64(F.trim(line))


def _worded(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _long(line: Column) -> Column:
    """Whether the line has more than LONG_WORDS words; short lines need not be split to tell."""
    return F.when(F.length(line) > 2 * LONG_WORDS, F.size(W.split_words(line, W.BLANKS)) > LONG_WORDS).otherwise(F.lit(False))


def _keys(text: Column) -> Column:
    """Distinct (key, whether long) of the lines that hold a word."""
    worded = F.filter(_lines(text), _worded)
    return F.array_distinct(F.transform(worded, lambda line: F.struct(_line_key(line).alias("line"), _long(line).alias("long"))))


def spread_lines(
    docs: DataFrame, text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES, long_sites: int = LONG_SITES
) -> DataFrame:
    """Keys (line) of the lines that occur on ``min_sites`` distinct sites or more, or are long and occur on ``long_sites``.

    Each line key gathers a HyperLogLog sketch of its sites; sketches are filled
    within a task and merged by aggregation, so a line of every document costs one
    sketch per task. An estimate clearly above or below the threshold decides; for
    the lines in between distinct sites are counted exactly. A null site counts as
    one site.
    """
    # A sketch passes over empty strings, so each site gets a first letter.
    site = F.concat(F.lit("s"), F.coalesce(F.col(site_col).cast("string"), F.lit("")))
    lines = docs.select(site.alias("site"), F.inline(_keys(F.col(text_col))))
    sketches = lines.groupBy("line", "long").agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"))
    need = F.when(F.col("long"), F.lit(long_sites)).otherwise(F.lit(min_sites)).alias("need")
    spread = sketches.select("line", need, F.hll_sketch_estimate("sketch").alias("estimate"))
    spread = settle(spread.where(F.col("estimate") >= F.col("need") * (1 - MARGIN)), "spread")
    sure = F.col("estimate") > F.col("need") * (1 + MARGIN)
    exact = lines.join(spread.where(~sure), "line").groupBy("line", "need").agg(F.count_distinct("site").alias("sites"))
    return spread.where(sure).select("line").unionByName(exact.where(F.col("sites") >= F.col("need")).select("line"))


def remove_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    long_sites: int = LONG_SITES,
) -> DataFrame:
    """Columns (row, text, n_lines, n_removed): each input row whole, its text without cross-site boilerplate.

    Boilerplate is every line with a word, compared without outer blanks (tabs and
    carriage returns count), that occurs on ``min_sites`` distinct sites, or has more
    than 50 words and occurs on ``long_sites``. It is cut from each document that
    has a worded line of its own left. One whose worded lines are all boilerplate is
    a copy of a whole document and stays as it is, for a near-duplicate stage to
    decide. Repeats within fewer sites stay, however many.

    The list of lines has no size bound and no broadcast hint. Documents meet their
    lines by a key of id and text, so copies of one text do not share a key. A null
    text stays null with no lines; blank lines always stay; repeated rows give their
    own rows, whatever their columns are called.
    """
    spread = settle(spread_lines(docs, text_col, site_col, min_sites, long_sites), "boilerplate")
    key = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"), F.col(text_col).alias("text"))
    places = rows.select("key", F.inline(_keys(F.col("text")))).join(spread, "line")
    carried = places.groupBy("key").agg(F.collect_set("line").alias("bad"))
    rows = rows.join(carried, "key", "left").select("row", "text", "bad", _lines(F.col("text")).alias("lines"))
    kept = F.filter("lines", lambda line: ~F.array_contains("bad", _line_key(line)) | ~_worded(line))
    rows = rows.select("row", "text", "lines", F.when(F.col("bad").isNull(), F.col("lines")).otherwise(kept).alias("kept"))
    cut = F.array_join("kept", "\n")
    carrier = (F.size("kept") < F.size("lines")) & F.exists("kept", _worded)
    n_lines = F.greatest(F.size(F.coalesce("lines", F.array().cast("array<string>"))), F.lit(0)).cast("long")
    return rows.select(
        "row",
        F.when(carrier, cut).otherwise(F.col("text")).alias("text"),
        n_lines.alias("n_lines"),
        F.when(carrier, F.size("lines") - F.size("kept")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
    )
