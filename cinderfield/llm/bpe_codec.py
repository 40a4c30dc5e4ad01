"""Byte-level BPE encoding and decoding of whole texts (operator 2).

Distinct words are encoded once for the whole corpus. Texts are taken in chunks
of about 16 MB; a chunk is its pre-tokens' positions (numbers into the chunk's
own word list) plus that list. Only the word lists meet in the global shuffle:

1. every chunk deals its distinct words into buckets by word hash;
2. a bucket holds all occurrences of its words, encodes each distinct word once
   and sends ids back under the chunk's key;
3. the chunk's positions arrive under the same key; ids join them by number and
   the texts are put together again in order of position.

So what is shuffled grows with distinct words per chunk, not with every
occurrence, and a word as frequent as " the" is one row entry per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderfield.llm import merges, pretokens

CHUNK_BYTES = 16 << 20
WORDS_AT_ONCE = 500_000
KNOWN_WORDS = 1_000_000  # distinct words whose ids a task holds before it begins anew


def squeeze(values: np.ndarray) -> bytes:
    """Small integers as compressed byte planes."""
    planes = np.ascontiguousarray(values, "<i4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[tuple[pa.RecordBatch, int, pa.Array, list[np.ndarray]]]:
    """Row ranges of about ``chunk_bytes`` of text: the rows, the chunk's key, its words
    in falling order of frequency, and each row's word numbers.

    The key is a hash of the texts themselves, so both passes over the same rows
    agree on it, and rows read in another order never meet a foreign word list.
    """
    for batch in batches:
        size = np.array(pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0))
        cuts = np.flatnonzero(np.diff(np.cumsum(size) // chunk_bytes)) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            rows = batch.slice(low, high - low)
            if rows.num_rows:
                yield rows, *_numbered(rows.column(1))


def _numbered(texts: pa.Array) -> tuple[int, pa.Array, list[np.ndarray]]:
    key = xxhash.xxh3_64()
    words, owners = [], []
    for data, bounds, row in pretokens.slices(texts):
        part, per_piece = pretokens.split(data, bounds)
        words.append(part)
        owners.append(np.repeat(row, per_piece))
        key.update(data)
        key.update(bounds.tobytes())
    coded = pa.chunked_array(words, pa.binary()).dictionary_encode()
    number = np.concatenate([c.indices.to_numpy() for c in coded.chunks]) if len(coded) else np.zeros(0, np.int32)
    distinct = coded.chunk(0).dictionary if len(coded) else pa.array([], pa.binary())
    order = np.argsort(-np.bincount(number, minlength=len(distinct)), kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    per_row = np.bincount(np.concatenate(owners), minlength=len(texts)) if owners else np.zeros(len(texts), int)
    numbers = np.split(place[number], np.cumsum(per_row)[:-1])
    return key.intdigest() - (1 << 63), distinct.take(pa.array(order)), numbers


def _word_lists(buckets: int, chunk_bytes: int):
    def deal(batches):
        for _, key, words, _ in _chunks(batches, chunk_bytes):
            plain = words.to_pylist()
            bucket = np.fromiter((xxhash.xxh32_intdigest(w) for w in plain), np.uint32, len(plain)) % buckets
            order = np.argsort(bucket, kind="stable")
            present, start = np.unique(bucket[order], return_index=True)
            parts = np.split(order, start[1:]) if len(order) else []
            joined = [[plain[i] for i in part] for part in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key] * len(parts), pa.int64()),
                    pa.array(present.astype(np.int32)),
                    pa.array([squeeze(np.diff(part, prepend=0)) for part in parts], pa.binary()),
                    pa.array([squeeze(np.array([len(w) for w in ws])) for ws in joined], pa.binary()),
                    pa.array([zstandard.compress(b"".join(ws), 3) for ws in joined], pa.binary()),
                ],
                names=["chunk", "bucket", "numbers", "lengths", "words"],
            )
        pretokens.give_back()

    return deal


def _encode_words(shared):
    """Each distinct word of the partition's buckets is merged once, then looked up."""

    def encode(batches):
        table, known = shared.value, {}
        for batch in batches:
            keys, numbers, sizes, ids = [], [], [], []
            for key, number, lengths, packed in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                data, ends = zstandard.decompress(packed), np.cumsum(unsqueeze(lengths))
                words = [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                if len(known) > KNOWN_WORDS:
                    known.clear()  # bounds a task's memory; words met again are merged again
                if new := [w for w in words if w not in known]:
                    flat, counts = merges.encode(pa.array(new, pa.binary()), table)
                    raw, stops = flat.astype("<i4").tobytes(), 4 * np.cumsum(counts)
                    known.update(zip(new, (raw[b - 4 * n : b] for b, n in zip(stops, counts, strict=True)), strict=True))
                found = [known[w] for w in words]
                keys.append(key)
                numbers.append(number)
                sizes.append(squeeze(np.array([len(f) // 4 for f in found])))
                ids.append(squeeze(np.frombuffer(b"".join(found), "<i4")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([0] * len(keys), pa.int32()), pa.array(numbers, pa.binary()), pa.array(sizes, pa.binary()), pa.array(ids, pa.binary())],
                names=["chunk", "kind", "numbers", "sizes", "ids"],
            )
        known.clear()
        pretokens.give_back()

    return encode


def _positions(chunk_bytes: int):
    def place(batches):
        for rows, key, _, numbers in _chunks(batches, chunk_bytes):
            packed = [squeeze(n) for n in numbers]
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(packed), pa.int64()), pa.array([1] * len(packed), pa.int32()), pa.array(packed, pa.binary()), rows.column(0)],
                names=["chunk", "kind", "numbers", "id"],
            )
        pretokens.give_back()

    return place


class _Words:
    """Ids by word number of one chunk."""

    def __init__(self, parts: list[tuple[bytes, bytes, bytes]]):
        numbers = [np.cumsum(unsqueeze(p[0])) for p in parts]
        counts = [unsqueeze(p[1]) for p in parts]
        self.flat = np.concatenate([unsqueeze(p[2]) for p in parts]) if parts else np.zeros(0, np.int32)
        size = 1 + max((int(n.max()) for n in numbers), default=-1)
        self.count, self.start = np.zeros(size, np.int64), np.zeros(size, np.int64)
        if parts:
            number, count = np.concatenate(numbers), np.concatenate(counts)
            self.count[number] = count
            self.start[number] = np.cumsum(count) - count

    def ids(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a sequence of word numbers, and how many each word gave."""
        if len(words) and (words.max() >= len(self.count) or not self.count[words].all()):
            raise RuntimeError("the input changed between two reads; write it to a table first")
        count = self.count[words]
        jump = np.repeat(self.start[words] - (np.cumsum(count) - count), count)
        return self.flat[jump + np.arange(len(jump))], count


def _reassemble(id_type: pa.DataType):
    def join(batches):
        chunk, parts, words = None, [], None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            pending: list[tuple[int, np.ndarray]] = []
            size = 0

            def flush():
                lengths = [len(n) for _, n in pending]
                flat, count = words.ids(np.concatenate([n for _, n in pending]))
                ends = np.cumsum(lengths)
                steps = np.append(0, np.cumsum(count))[np.append(0, ends)]
                lists = pa.ListArray.from_arrays(pa.array(steps.astype(np.int32)), pa.array(flat.astype(np.int32)))
                ids = batch.column(5).take(pa.array([i for i, _ in pending])).cast(id_type)
                return pa.RecordBatch.from_arrays([ids, lists], names=["id", "ids"])

            for i, (key, kind, number, sizes, ids) in enumerate(zip(*columns, strict=True)):
                if key != chunk:
                    if pending:
                        yield flush()
                        pending, size = [], 0
                    chunk, parts, words = key, [], None
                if kind == 0:
                    parts.append((number, sizes, ids))
                    continue
                words = words or _Words(parts)
                pending.append((i, unsqueeze(number)))
                size += len(pending[-1][1])
                if size >= WORDS_AT_ONCE:
                    yield flush()
                    pending, size = [], 0
            if pending:
                yield flush()
        words = None
        pretokens.give_back()

    return join


def encode(
    docs: DataFrame,
    ranks: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int | None = None,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Rows (id, ids array<int>): every whole text by the ranks file, without special tokens.

    ``docs`` is read twice and must give the same rows in the same partitions both
    times, as a table does; if it doesn't, the job fails instead of mixing words.
    ``buckets`` (default: the session's shuffle partitions) should leave a task
    below KNOWN_WORDS distinct words, which it keeps in memory; beyond that it forgets
    them and merges those that come again once more, so memory stays bounded.

    Null and empty texts give an empty array; repeated rows and null ids each give
    their own row; other columns are ignored. Lost executors cost shuffle files
    only, which Spark rebuilds from the input.
    """
    together, join = _gathered(docs, ranks, id_col, text_col, buckets, chunk_bytes)
    return together.mapInArrow(join, T.StructType([docs.schema[id_col], _IDS]))


_IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))


def _gathered(docs: DataFrame, ranks: str, id_col: str, text_col: str, buckets: int | None, chunk_bytes: int):
    """Each chunk's encoded words and positions side by side, and the function that joins them."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(merges.from_ranks(merges.read_ranks(ranks)))  # one vocabulary
    parts = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()

    dealt = rows.mapInArrow(_word_lists(parts, chunk_bytes), "chunk long, bucket int, numbers binary, lengths binary, words binary")
    encoded = dealt.repartition(parts, "bucket").mapInArrow(
        _encode_words(shared), "chunk long, kind int, numbers binary, sizes binary, ids binary"
    )
    positions = rows.mapInArrow(_positions(chunk_bytes), f"chunk long, kind int, numbers binary, id {id_type}")
    both = encoded.unionByName(positions, allowMissingColumns=True).select("chunk", "kind", "numbers", "sizes", "ids", "id")
    together = both.repartition(parts, "chunk").sortWithinPartitions("chunk", "kind")
    return together, _reassemble(pa.schema(_arrow(id_type)).field(0).type)


def _arrow(id_type: str) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return list(to_arrow_schema(T.StructType.fromDDL(f"id {id_type}")))


def decode(encoded: DataFrame, ranks: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (id, bytes): ids joined with the token-byte table and put together in order.

    The table is the vocabulary itself: bounded, broadcast, and looked up by array
    index. An id outside the table fails the job. A null or empty array gives empty bytes.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(merges.read_ranks(ranks))
    schema = T.StructType([encoded.schema[id_col], T.StructField("bytes", T.BinaryType())])
    lookup, names = _token_bytes(shared), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lookup(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], names=names)

    return encoded.select(id_col, ids_col).mapInArrow(run, schema)


def _token_bytes(shared):
    """Adds the decoded bytes to batches of (anything, ids)."""

    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(shared.value, pa.large_binary())
        for batch in batches:
            lists = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
            per_text = np.array(pa.compute.fill_null(pa.compute.list_value_length(lists), 0), np.int64)
            total = np.cumsum(per_text)
            cuts = np.flatnonzero(np.diff(total // WORDS_AT_ONCE)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(lists)], strict=True):
                tokens = table.take(lists.slice(low, high - low).flatten())
                ends = np.frombuffer(tokens.buffers()[1], np.int64, len(tokens) + 1)
                data = (tokens.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
                at = ends[np.append(0, np.cumsum(per_text[low:high]))] if len(tokens) else np.zeros(high - low + 1, np.int64)
                texts = [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
                rows = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(texts, pa.binary())], names=["id", "ids", "bytes"])
        pretokens.give_back()

    return lookup


def digests(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows (id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of what they decode to.

    The same steps as ``encode`` and ``decode``, the last two in one Python worker;
    only digests leave.
    """
    together, join = _gathered(docs, ranks, id_col, text_col, None, chunk_bytes)
    lookup = _token_bytes(docs.sparkSession.sparkContext.broadcast(merges.read_ranks(ranks)))
    schema = T.StructType([docs.schema[id_col], _IDS, T.StructField("bytes", T.BinaryType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lookup(join(batches)):
            yield pa.RecordBatch.from_arrays(batch.columns, names=names)

    return together.mapInArrow(run, schema).select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
