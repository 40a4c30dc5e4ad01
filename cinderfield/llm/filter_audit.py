"""What each filter of a chain removes in every order of application (operator 12).

Five filters have 32 subsets. A document's failures, a five-bit mask, become a
32-bit survival word: bit S is set if the document survives the filters of subset
S. Counting the set bits by position over all words of a part gives the survivors
of all subsets at once, and every figure of every order is a difference of two of
them. Positions are counted by carry-save adders: three words of weight w become
one of weight w and one of weight 2w, so a batch is summed in a few passes of bit
operations over whole arrays.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderfield.llm import words as W
from cinderfield.scratch import settle

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
ALL = SUBSETS - 1
COPY_BIT = 1 << FILTERS.index("E")
GOOD, TOXIC = 1, 2
#: Survival word of each failure mask.
SURVIVAL = np.array([sum(1 << s for s in range(SUBSETS) if not s & mask) for mask in range(SUBSETS)], np.uint32)


def text_failures(text: Column) -> Column:
    """Mask of the filters A to D that a text fails.

    A: under 50 words. B: under 65 in 100 words are distinct. C: more than 5 in 100
    characters are A-Z. D: one of ``#$%&*|`` occurs. An empty text fails A only.
    """
    words = W.split_words(text, W.BLANKS)
    chars = F.length(text)
    failures = (
        F.size(words) < 50,
        100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        100 * (chars - F.length(F.regexp_replace(text, "[A-Z]+", ""))) > 5 * chars,
        text.rlike("[#$%&*|]"),
    )
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(failures)), F.lit(0))


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Rows (id, part, fails), one for each document: its mask of all five filters.

    E: the text is that of a document with a smaller id, wherever it is. Texts are
    compared by their SHA-256; only digests and ids are shuffled. A null text is
    empty, a null part is the empty string; a row without id fails E only if a row
    with one has the same text. Rows that repeat the smallest id do not fail E.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    digest = F.unhex(F.sha2(text, 256)).alias("digest")
    rows = settle(docs.select(F.col(id_col).alias("id"), part.alias("part"), digest, text_failures(text).alias("fails")), "failures")
    copies = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    joined = rows.join(copies.select("digest", "first"), "digest", "left")
    later = F.col("first").isNotNull() & ~F.coalesce(F.col("id") <= F.col("first"), F.lit(False))
    return joined.select("id", "part", (F.col("fails") + F.when(later, F.lit(COPY_BIT)).otherwise(F.lit(0))).alias("fails"))


def labelled(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds ``marks``: 1 if any label of the id has quality 1, 2 more if any has toxic 1."""
    marks = F.max((F.coalesce(F.col("quality"), F.lit(0)) == 1).cast("int")) * GOOD + F.max((F.coalesce(F.col("toxic"), F.lit(0)) == 1).cast("int")) * TOXIC
    found = labels.groupBy(F.col(id_col).alias("label_id")).agg(marks.alias("marks")).where(F.col("marks") > 0)
    joined = rows.join(found, F.col("id") == F.col("label_id"), "left")
    return joined.select("id", "part", "fails", F.coalesce("marks", F.lit(0)).alias("marks"))


def positional_counts(owner: np.ndarray, words: np.ndarray, owners: int) -> np.ndarray:
    """Set bits [owner, position] over the words of each owner; ``owner`` is sorted."""
    out = np.zeros((owners, SUBSETS), np.int64)
    weight = 1
    while len(words):
        carries = []
        while (size := np.bincount(owner, minlength=owners)).max() > 1:
            at = np.arange(len(words)) - (np.cumsum(size) - size)[owner]
            first = np.flatnonzero(at % 3 == 0)
            left = size[owner[first]] - at[first]  # words of this owner from here on
            padded = np.append(words, np.zeros(2, np.uint32))
            a = words[first]
            b = np.where(left > 1, padded[first + 1], 0).astype(np.uint32)
            c = np.where(left > 2, padded[first + 2], 0).astype(np.uint32)
            half = a ^ b
            carries.append((owner[first], (a & b) | (half & c)))
            words, owner = half ^ c, owner[first]
        out[owner] += weight * ((words[:, None] >> np.arange(SUBSETS, dtype=np.uint32)) & 1).astype(np.int64)
        owner = np.concatenate([o for o, _ in carries]) if carries else np.zeros(0, np.int64)
        words = np.concatenate([w for _, w in carries]) if carries else np.zeros(0, np.uint32)
        order = np.flatnonzero(words)
        order = order[np.argsort(owner[order], kind="stable")]
        owner, words = owner[order], words[order]
        weight *= 2
    return out


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        coded = batch.column(0).dictionary_encode()
        owner = coded.indices.to_numpy()
        order = np.argsort(owner, kind="stable")
        owner, words = owner[order], SURVIVAL[batch.column(1).to_numpy()[order]]
        marks = batch.column(2).to_numpy()[order]
        counts = []
        for chosen in (slice(None), np.flatnonzero(marks & GOOD), np.flatnonzero(marks & TOXIC)):
            found = positional_counts(owner[chosen], words[chosen], len(coded.dictionary))
            counts.append(pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), SUBSETS).cast(pa.list_(pa.int64())))
        yield pa.RecordBatch.from_arrays([coded.dictionary, *counts], names=["part", "every", "good", "toxic"])


def survivors(marked: DataFrame) -> DataFrame:
    """Rows (part, every, good, toxic): documents of the part that survive each subset, as arrays of 32.

    Words are counted within a batch of rows, so a part of a third of all documents
    sends one row per batch; ``every`` counts all documents, ``good`` and ``toxic``
    those so marked. No rows give no parts.
    """
    arrays = ("every", "good", "toxic")
    sums = marked.select("part", "fails", "marks").mapInArrow(_sums, "part string, " + ", ".join(f"{a} array<bigint>" for a in arrays))
    totals = sums.groupBy("part").agg(*[F.sum(F.get(a, F.lit(s))).alias(f"{a}{s}") for a in arrays for s in range(SUBSETS)])
    return totals.select("part", *[F.array(*[f"{a}{s}" for s in range(SUBSETS)]).alias(a) for a in arrays])


def _steps() -> Column:
    """Every order and step as structs: subsets before and after, and the step's filter."""
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = FILTERS.index(name)
            steps.append(("".join(order), step, bit, 1 << bit, before, before | 1 << bit))
            before |= 1 << bit
    names = ("filter_order", "step", "bit", "own", "before", "after")
    rows = json.dumps([dict(zip(names, s, strict=True)) for s in steps])
    return F.from_json(F.lit(rows), "array<struct<filter_order: string, step: int, bit: int, own: int, before: int, after: int>>")


def _shapley() -> Column:
    """Per filter, documents it removes summed over all orders: orders that share a subset are counted by factorials."""
    def of(bit: int) -> Column:
        terms = []
        for s in (s for s in range(SUBSETS) if not s >> bit & 1):
            orders = factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count())
            terms.append(orders * (F.get("every", F.lit(s)) - F.get("every", F.lit(s | 1 << bit))))
        return sum(terms[1:], terms[0])

    return F.array(*[of(bit) for bit in range(len(FILTERS))])


def report(counted: DataFrame) -> DataFrame:
    """One row per part, order and step from what ``survivors`` returns.

    ``kept`` after the step, ``removed`` by it, ``redundant`` that fail its filter
    but were gone already, ``unique_fails`` that fail no other filter, ``good_lost``
    and ``toxic_lost`` of the removed, and ``shapley``, its filter's removed summed
    over all orders.
    """
    rows = counted.select("*", _shapley().alias("shapley")).select("*", F.explode(_steps()).alias("s"))

    def drop(array: str) -> Column:
        return F.get(array, F.col("s.before")) - F.get(array, F.col("s.after"))

    fails = F.get("every", F.lit(0)) - F.get("every", F.col("s.own"))
    return rows.select(
        "part",
        F.col("s.filter_order").alias("filter_order"),
        F.col("s.step").alias("step"),
        F.get("every", F.col("s.after")).alias("kept"),
        drop("every").alias("removed"),
        (fails - drop("every")).alias("redundant"),
        (F.get("every", F.lit(ALL) - F.col("s.own")) - F.get("every", F.lit(ALL))).alias("unique_fails"),
        drop("good").alias("good_lost"),
        drop("toxic").alias("toxic_lost"),
        F.get("shapley", F.col("s.bit")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``report`` over all documents: five filters in all 120 orders, per part.

    Repeated rows count each; rows without id have no label; empty texts fail A, and
    E if another is smaller. Other columns are ignored, whatever they are called.
    """
    return report(survivors(labelled(failures(docs, id_col, text_col, part_col), labels)))
