"""Quality classifier: a factorisation machine over hashed words, structure and metadata (operator 9)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderfield.llm import pretokens
from cinderfield.scratch import settle

BUCKETS = 1 << 12
FACTORS = 8
DENSE = 13
SIZE = BUCKETS + DENSE
ROWS_AT_ONCE = 2000
SAMPLE_ROWS = 3000


@dataclass
class Sparse:
    """Rows of (feature, value) pairs: row i owns ``bounds[i]:bounds[i + 1]``."""

    bounds: np.ndarray
    index: np.ndarray
    value: np.ndarray


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    std: np.ndarray


def raw_features(texts: pa.Array, n_chars: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, tf) of the hashed words and the structure statistics [row, DENSE] of each text."""
    n = len(texts)
    counts = np.zeros((n, 8))  # bytes, words, upper, digit, mark, line ends, non-ASCII, symbols
    keys = []
    for data, bounds, row in pretokens.slices(texts):
        raw = np.frombuffer(data, np.uint8)
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        word_end = np.zeros(len(raw), bool)  # last byte of a word
        word_end[:-1] = ~space[:-1] & space[1:]
        last = bounds[1:][np.diff(bounds) > 0] - 1
        word_end[last] = ~space[last]
        upper, digit = (raw >= 65) & (raw <= 90), (raw >= 48) & (raw <= 57)
        mark = (raw > 32) & (raw < 127) & ~digit & ~upper & ~((raw >= 97) & (raw <= 122))
        symbol = np.isin(raw, np.frombuffer(b"#*$%&|<>", np.uint8))
        measures = (np.ones(len(raw), bool), word_end, upper, digit, mark, raw == 10, raw >= 128, symbol)
        for k, flags in enumerate(measures):
            total = np.append(0, np.cumsum(flags))[bounds]
            np.add.at(counts[:, k], row, np.diff(total))
        body = raw[~space] + 32 * upper[~space].astype(np.uint8)
        kept = np.append(0, np.cumsum(~space))
        ends = kept[np.flatnonzero(word_end) + 1]
        if not len(ends):
            continue
        offsets = np.append(0, ends).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).dictionary_encode()
        hashed = np.fromiter((xxhash.xxh32_intdigest(w) for w in words.dictionary.to_pylist()), np.int64) % BUCKETS
        per_piece = np.diff(np.append(0, np.cumsum(word_end))[bounds])
        keys.append(np.repeat(row, per_piece) * BUCKETS + hashed[words.indices.to_numpy()])
    key, tf = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    row, bucket = key // BUCKETS, key % BUCKETS
    size, words = np.maximum(counts[:, 0], 1), np.maximum(counts[:, 1], 1)
    distinct = np.bincount(row, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, row, tf)
    listed = np.nan_to_num(np.array(n_chars.cast(pa.float64()).to_numpy(zero_copy_only=False), float))
    dense = np.column_stack(
        [
            np.log1p(counts[:, 1]),
            counts[:, 0] / words,
            *(counts[:, k] / size for k in (2, 3, 4, 6, 7)),
            counts[:, 5] / words,
            distinct / words,
            most / words,
            np.log1p(np.maximum(listed, 0)),
            counts[:, 1] == 0,
            np.sqrt(counts[:, 2] / size),
        ]
    )
    return row, bucket, tf, dense


def sparse(row: np.ndarray, bucket: np.ndarray, tf: np.ndarray, dense: np.ndarray, mean: np.ndarray, std: np.ndarray) -> Sparse:
    """Word weights log(1 + tf) of length one per text, then the standardised statistics."""
    n = len(dense)
    weight = np.log1p(tf)
    norm = np.sqrt(np.bincount(row, weight**2, n))
    weight = weight / norm[row] if len(row) else weight
    scaled = np.clip((dense - mean) / std, -4, 4)
    rows = np.concatenate([row, np.repeat(np.arange(n), DENSE)])
    order = np.argsort(rows, kind="stable")
    index = np.concatenate([bucket, np.tile(BUCKETS + np.arange(DENSE), n)])[order]
    value = np.concatenate([weight, scaled.ravel()])[order]
    return Sparse(np.append(0, np.cumsum(np.bincount(rows, minlength=n))), index, value)


def margins(x: Sparse, m: Machine) -> tuple[np.ndarray, np.ndarray]:
    """Model output of each row, and the factor sums: pairs cost linear time because
    the sum over pairs is (square of the sum - sum of the squares) / 2."""
    starts = x.bounds[:-1]
    scaled = m.factors[x.index] * x.value[:, None]
    sums = np.add.reduceat(scaled, starts, axis=0)
    squares = np.add.reduceat(scaled**2, starts, axis=0)
    linear = np.add.reduceat(m.linear[x.index] * x.value, starts)
    return m.bias + linear + 0.5 * (sums**2 - squares).sum(axis=1), sums


def train(x: Sparse, y: np.ndarray, mean: np.ndarray, std: np.ndarray, epochs: int = 12, step: float = 0.08, decay: float = 1e-4) -> Machine:
    """Logistic loss, AdaGrad on batches of 64, a fixed seed."""
    random = np.random.default_rng(7)
    share = np.clip(y.mean(), 0.01, 0.99)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(SIZE), random.normal(0, 0.02, (SIZE, FACTORS)), mean, std)
    seen_linear, seen_factors, seen_bias = np.full(SIZE, 1e-2), np.full((SIZE, FACTORS), 1e-2), 1e-2
    for _ in range(epochs):
        for rows in np.array_split(random.permutation(len(y)), max(1, len(y) // 64)):
            sizes = x.bounds[rows + 1] - x.bounds[rows]
            bounds = np.append(0, np.cumsum(sizes))
            at = np.repeat(x.bounds[rows] - bounds[:-1], sizes) + np.arange(bounds[-1])
            part = Sparse(bounds, x.index[at], x.value[at])
            out, sums = margins(part, m)
            error = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[rows]) / len(rows)
            of = np.repeat(np.arange(len(rows)), sizes)
            used, place = np.unique(part.index, return_inverse=True)
            slope = np.bincount(place, error[of] * part.value, len(used)) + decay * m.linear[used]
            each = error[of, None] * part.value[:, None] * (sums[of] - m.factors[part.index] * part.value[:, None])
            pair = np.column_stack([np.bincount(place, each[:, k], len(used)) for k in range(FACTORS)]) + decay * m.factors[used]
            seen_linear[used] += slope**2
            seen_factors[used] += pair**2
            seen_bias += error.sum() ** 2
            m.linear[used] -= step * slope / np.sqrt(seen_linear[used])
            m.factors[used] -= step * pair / np.sqrt(seen_factors[used])
            m.bias -= step * error.sum() / np.sqrt(seen_bias)
    return m


def score_batch(texts: pa.Array, n_chars: pa.Array, m: Machine) -> np.ndarray:
    scores = [np.zeros(0)]
    for low in range(0, len(texts), ROWS_AT_ONCE):
        parts = raw_features(texts.slice(low, ROWS_AT_ONCE), n_chars.slice(low, ROWS_AT_ONCE))
        out, _ = margins(sparse(*parts, m.mean, m.std), m)
        scores.append(1 / (1 + np.exp(-np.clip(out, -30, 30))))
    return np.concatenate(scores)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size_col: str = "n_chars",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Machine:
    """A machine trained on a bounded sample of labelled rows.

    Bound: ``sample_rows`` labelled ids, those with the smallest hash. Features are
    made where the texts lie and only the sample's come to the driver. Several
    labels of one id count by their mean; null ids and labels are left out. The
    machine learns from text and size only, never from the id, language or source.
    """
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("label_id"))
        .agg((F.avg(label_col) >= 0.5).cast("double").alias("y"))
        .orderBy(F.xxhash64(F.col("label_id").cast("string")), "label_id")
        .limit(sample_rows)
    )
    chosen = settle(chosen, "sample")  # its size is known then, and small
    rows = docs.select(F.col(id_col), F.col(text_col), F.col(size_col).cast("double")).toDF("id", "text", "size")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, bucket, tf, dense = raw_features(batch.column(1), batch.column(2))
            cuts = np.searchsorted(row, np.arange(1, batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([b.astype(np.int32) for b in np.split(bucket, cuts)], pa.list_(pa.int32())),
                    pa.array([t.astype(np.int32) for t in np.split(tf, cuts)], pa.list_(pa.int32())),
                    pa.array(list(dense), pa.list_(pa.float64())),
                ],
                names=["y", "buckets", "tf", "dense"],
            )

    # One text for each id, however often rows repeat it: what reaches the driver is bounded by rows, not ids.
    place = F.row_number().over(Window.partitionBy("label_id").orderBy(F.xxhash64("text"), "text"))
    sample = rows.join(chosen, F.col("id") == F.col("label_id")).withColumn("place", place).where(F.col("place") == 1).select("y", "text", "size")
    found = sample.mapInArrow(extract, "y double, buckets array<int>, tf array<int>, dense array<double>").toPandas()
    if not len(found):
        return Machine(0.0, np.zeros(SIZE), np.zeros((SIZE, FACTORS)), np.zeros(DENSE), np.ones(DENSE))
    found = found.sort_values(["y", "dense"], key=lambda c: c if c.name == "y" else c.map(tuple)).reset_index(drop=True)
    dense = np.array(found["dense"].tolist())
    mean, std = dense.mean(axis=0), dense.std(axis=0) + 1e-6
    row = np.repeat(np.arange(len(found)), found["tf"].map(len))
    bucket, tf = (np.concatenate([np.asarray(v, np.int64) for v in found[c]]) for c in ("buckets", "tf"))
    return train(sparse(row, bucket, tf, dense, mean, std), found["y"].to_numpy(), mean, std)


def scorer(docs: DataFrame, machine: Machine) -> Callable[[Column, Column], Column]:
    """A column function: text and size to a score in 0 to 1, higher for better texts.

    Whole texts are read. A null text counts as empty, a null size as 0; both get a
    score. There is no shuffle; the machine has a fixed size and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.arrow_udf("double")
    def score(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, sizes in batches:
            yield pa.array(score_batch(texts, sizes, shared.value))

    return lambda text, size: score(text, size.cast("double"))
