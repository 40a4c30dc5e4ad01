"""Token counts of whole texts by rank-synchronous merging (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderfield.llm import merges, pretokens


def _without_added(column: pa.Array, added: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts cut at added tokens: the pieces, each piece's row, and how many added tokens each row holds."""
    found = np.zeros(len(column), np.int64)
    for token in added:
        found += pc.fill_null(pc.count_substring(column, token), 0).to_numpy(zero_copy_only=False)
    rows = np.arange(len(column))
    if not found.any():
        return column, rows, found
    longest_first = sorted(added, key=len, reverse=True)
    cutter = pretokens.regex.compile("|".join(map(pretokens.regex.escape, longest_first)))
    pieces, of = [], []
    for row, text in enumerate(column.to_pylist()):
        parts = cutter.split(text) if found[row] else [text]
        found[row] = len(parts) - 1
        pieces += parts
        of += [row] * len(parts)
    return pa.array(pieces, pa.string()), np.array(of), found


def batch_counts(column: pa.Array, table: merges.MergeTable, added: list[str]) -> np.ndarray:
    """Tokens of each text of one batch; null counts as empty."""
    pieces, row_of_piece, total = _without_added(column, added)
    words, owners = [], []
    for data, bounds, piece in pretokens.slices(pieces):
        part, per_piece = pretokens.split(data, bounds)
        words.append(part)
        owners.append(np.repeat(row_of_piece[piece], per_piece).astype(np.int32))
    if not words:
        return total
    # The dictionary holds each pre-token of the batch once; only those are merged.
    coded = pa.chunked_array(words, pa.binary()).dictionary_encode()
    if not len(coded):
        return total
    _, sizes = merges.encode(coded.chunk(0).dictionary, table)
    index = np.concatenate([c.indices.to_numpy() for c in coded.chunks])
    return total + np.bincount(np.concatenate(owners), sizes[index], len(column)).astype(np.int64)


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_bytes, n_tokens): UTF-8 bytes and byte-level BPE tokens of every text.

    ``tokenizer`` is a file in the tokenizers JSON format whose pre-tokenizer is
    plain byte level. Pre-tokens of an Arrow batch lie in ragged numpy arrays;
    in every round each sequence applies its own lowest-rank pair, and the
    symbols that survive are counted. A string of an added token inside a text
    is one token, as the library has it; no begin, end or other token is added.

    There is no shuffle: a lost task is read again. Memory follows the Arrow
    batch, and texts over 3 MB are handled in pieces cut where a pre-token must
    begin. Null and empty texts have 0 bytes and 0 tokens; every input row, repeated
    or with a null id, gives one output row; other columns are ignored.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(merges.read_json(tokenizer))  # one vocabulary
    id_field = docs.schema[id_col]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, added = shared.value
        for batch in batches:
            n = batch_counts(batch.column(1), table, added)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n)], names=names)

    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    schema = T.StructType([id_field, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    names = schema.names
    return docs.select(F.col(id_col), F.col(text_col), size).toDF("id", "text", "size").mapInArrow(count, schema)
