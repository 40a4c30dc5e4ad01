"""Quality rules by distribution divergence, in DataFrame functions only (operator 7)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderfield.llm import words as W
from cinderfield.scratch import settle

SYMBOLS = "[#*$%&|<>]+"
#: Character classes over the characters of words; what is left is one more class.
CLASSES = {"lower": "[a-z]+", "upper": "[A-Z]+", "digit": "[0-9]+", "mark": r"[!-/:-@\[-`{-~]+"}
#: All but the characters of words that are not a-z: a short rest of most texts.
LOWER_OR_BLANK = r"[a-z\x20\x09-\x0D]+"
COMMON_WORDS = 24
CODES = [chr(ord("A") + i) for i in range(COMMON_WORDS)]
HAS_WORD = r"[^\x20\x09-\x0D]"
WINDOW = 5


@dataclass(frozen=True)
class Limits:
    """Largest Jensen-Shannon distances (0 to 1) of a text of n words: base + slack / sqrt(n).

    The slack leaves room for the chance differences of short texts; texts below
    ``min_words`` are not asked at all.
    """

    char_base: float = 0.2
    char_slack: float = 0.8
    word_base: float = 0.25
    word_slack: float = 1.1
    min_words: int = 20


def _removed(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def _worded(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = W.split_words(text, W.BLANKS)
    return docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), text.alias("text"), words.alias("words"))


def _with_classes(rows: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, the class counts and n_symbols.

    One pass takes out a-z and blanks; the other classes are counted in what is left.
    """
    rows = rows.withColumn("left", F.regexp_replace("text", LOWER_OR_BLANK, "")).withColumn("n_words", F.size("words").cast("long"))
    rows = rows.withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
    counts = {name: _removed(F.col("left"), pattern) for name, pattern in CLASSES.items() if name != "lower"}
    lower = F.col("word_chars") - F.length("left")
    return rows.withColumns({"lower": lower, **counts, "n_symbols": _removed(F.col("left"), SYMBOLS)})


def _repeat_words(rows: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words inside windows of five that occur twice or more."""
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("windows", W.shingles(F.col("hashes"), WINDOW))
    # Nearly all texts repeat no window; only the others are sorted.
    pairs = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    none = F.array().cast("array<struct<h: bigint, i: int>>")
    rows = rows.withColumn(
        "ordered", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(pairs)).otherwise(none)
    )
    near = F.col("ordered")
    repeated = F.filter(
        near, lambda e, i: F.get(near, i - 1)["h"].eqNullSafe(e["h"]) | F.get(near, i + 1)["h"].eqNullSafe(e["h"])
    )
    starts = F.sort_array(F.transform(repeated, lambda e: e["i"]))
    total = F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, s: F.struct(s.alias("last"), (a["n"] + F.least(F.lit(WINDOW), s - a["last"])).alias("n")),
        lambda a: a["n"].cast("long"),
    )
    return rows.withColumn("n_repeat_words", total).drop("hashes", "windows", "ordered")


def references(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per language: shares of the character classes, its common words, and their shares.

    Counted over all texts with a language. Counts are added up within a task
    before they are shuffled, so a language with a third of all texts is no hot key.
    """
    rows = _worded(docs, id_col, text_col, lang_col).where(F.col("lang").isNotNull())
    names = [*CLASSES, "word_chars", "n_words"]
    sums = _with_classes(rows).groupBy("lang").agg(*[F.sum(n).alias(n) for n in names])
    counts = rows.select("lang", F.explode("words").alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    common = (
        counts.withColumn("place", place)
        .where(F.col("place") <= COMMON_WORDS)
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("place", "word", "n"))).alias("common"))
    )
    rest = F.col("word_chars") - reduce(lambda a, b: a + b, map(F.col, CLASSES))
    chars = F.transform(F.array(*CLASSES, rest), lambda n: n / F.col("word_chars"))
    found = F.transform("common", lambda c: c["n"].cast("double"))
    other = F.col("n_words") - F.aggregate(found, F.lit(0.0), lambda a, n: a + n)
    padded = F.concat(found, F.array_repeat(F.lit(0.0), F.lit(COMMON_WORDS) - F.size("common")), F.array(other))
    return (
        sums.where(F.col("word_chars") > 0)
        .join(common, "lang")
        .select(
            F.col("lang").alias("ref_lang"),
            chars.alias("ref_chars"),
            F.transform(padded, lambda n: n / F.col("n_words")).alias("ref_words"),
            F.array_max(F.transform("common", lambda c: F.octet_length(c["word"]))).alias("longest"),
            F.map_from_arrays(
                F.transform("common", lambda c: c["word"]),
                F.transform("common", lambda c: F.chr(F.lit(64) + c["place"])),
            ).alias("code_of"),
        )
    )


def distance(counts: Column, total: Column, shares: Column) -> Column:
    """Jensen-Shannon distance (base 2) between counts out of ``total`` and reference shares."""
    terms = F.zip_with(
        counts, shares, lambda n, q: _half(n / total, (n / total + q) / 2) + _half(q, (n / total + q) / 2)
    )
    total_divergence = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)
    return F.when(shares.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), total_divergence)))


def _half(p: Column, middle: Column) -> Column:
    return F.when(p > 0, p * F.log2(p / middle) / 2).otherwise(F.lit(0.0))


def judge(
    docs: DataFrame,
    reference: DataFrame,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Rows (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance, kept).

    A text fails the base rules with fewer than 10 words, or more than 20 in 100
    inside repeated windows of five. Otherwise its histograms of character classes
    and of its language's common words are held against the language's reference
    by Jensen-Shannon distance; one beyond its limit drops the text, but a distance
    is asked only of texts that are long enough for it.

    ``reference`` is what ``references`` returns, written to a table: its size is
    then known, and the join broadcasts it only if that is small. Null texts count
    as empty (no words: base rule failed); texts without a language, or of one
    without reference, have null distances and are judged by the base rules only.
    Repeated rows and null ids give their own rows; other columns are ignored.
    """
    rows = _with_classes(_worded(docs, id_col, text_col, lang_col)).join(reference, F.col("lang") == F.col("ref_lang"), "left")
    # Most words are longer than any common one.
    code = F.transform("words", lambda w: F.when(F.octet_length(w) <= F.col("longest"), F.try_element_at("code_of", w)))
    rows = rows.withColumn("coded", F.array_join(code, ""))
    rows = _repeat_words(rows)
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(HAS_WORD))
    rows = rows.withColumn("lines", lines)
    rest = F.col("word_chars") - reduce(lambda a, b: a + b, map(F.col, CLASSES))
    rows = rows.select(
        "id",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        "ref_chars",
        "ref_words",
        F.array(*CLASSES, rest).alias("classes"),
        F.array(*[F.length("coded") - F.length(F.replace("coded", F.lit(c), F.lit(""))) for c in CODES]).alias("found"),
    )
    other = F.col("n_words") - F.aggregate("found", F.lit(0), lambda a, n: a + n)
    words = F.concat(F.transform("found", lambda n: n.cast("bigint")), F.array(other))
    rows = rows.select(
        "*",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
        F.when(F.col("n_words") > 0, distance(F.col("classes"), F.col("word_chars"), F.col("ref_chars"))).alias("char_distance"),
        F.when(F.col("n_words") > 0, distance(words, F.col("n_words"), F.col("ref_words"))).alias("word_distance"),
    )
    spread = F.sqrt(F.col("n_words").cast("double"))
    odd = (F.col("n_words") >= limits.min_words) & (
        (F.col("char_distance") > limits.char_base + limits.char_slack / spread)
        | (F.col("word_distance") > limits.word_base + limits.word_slack / spread)
    )
    odd = F.coalesce(odd, F.lit(False))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    kept = (~F.col("base_failed") & ~odd).alias("kept")
    return rows.select(F.col("id").alias(id_col), *counts, "char_distance", "word_distance", kept)


def check(docs: DataFrame, limits: Limits = Limits(), **columns: str) -> DataFrame:
    """``judge`` against references counted over the same documents."""
    return judge(docs, settle(references(docs, **columns), "references"), limits, **columns)
