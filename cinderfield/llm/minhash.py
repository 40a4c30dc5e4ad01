"""Near-duplicate documents by b-bit MinHash (operator 5).

1. A pass over the texts makes, per document, the size and a 128-bit digest of its
   set of word shingles, 32 band keys of four minima each, and the low four bits
   of all 128 minima, packed as bit planes.
2. Documents of equal sets form a class with its smallest id as representative;
   only representatives go on, so thousands of copies are one row.
3. Representatives that share a band key are compared by bit counts alone, with the
   estimate corrected for chance collisions. In each bucket a search from its first
   member finds who hangs together above a safe bound; it visits a dense bucket in
   one sweep and emits one edge per member. Those edges give families.
4. A family's sets meet once, in slices of bounded size. Pairs above the bound are
   confirmed on full sets, the best estimates first, until no pair between two
   unlinked parts is left; one link per joined part leaves. Links give components.

So a group of n near copies costs n rows, never n squared, and no pair that could
join two components goes unconfirmed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderfield.llm import pretokens
from cinderfield.llm.components import components
from cinderfield.scratch import settle

BANDS, ROWS, BITS = 32, 4, 4
MINIMA = BANDS * ROWS
SLACK = 0.22  # six standard errors of the estimate at the threshold
CHANCE = 1 / (1 << BITS)
SLICE_ROWS = 4096
SLICE_SHINGLES = 4_000_000
ROWS_AT_ONCE = 500
_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(1, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z lower-cased, and how many words each text has."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(bounds) - 1, np.int64)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    ends = np.zeros(len(raw), bool)
    ends[:-1] = ~space[:-1] & space[1:]
    last = bounds[1:][np.diff(bounds) > 0] - 1
    ends[last] = ~space[last]
    counts = np.diff(np.append(0, np.cumsum(ends))[bounds])
    upper = ((raw >= 65) & (raw <= 90)).astype(np.uint8)
    body = (raw + 32 * upper)[~space]
    stops = np.append(0, np.cumsum(~space))[np.flatnonzero(ends) + 1]
    offsets = np.append(0, stops).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(stops), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).dictionary_encode()
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    return hashed[words.indices.to_numpy()], counts


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts one after another, and each text's bounds in them."""
    n = len(texts)
    hashes, owners = [], []
    for row, value in enumerate(texts.cast(pa.large_binary()).to_pylist()):
        hashes.append(value or b"")
        owners.append(row)
    bounds = np.append(0, np.cumsum([len(h) for h in hashes]))
    words, counts = _word_hashes(b"".join(hashes), bounds)
    first = np.append(0, np.cumsum(counts))
    made = np.maximum(counts - size + 1, (counts > 0).astype(np.int64))  # a short text is one shingle
    row = np.repeat(np.arange(n), made)
    begin = np.repeat(first[:-1], made) + np.arange(len(row)) - np.repeat(np.cumsum(made) - made, made)
    span = np.minimum(size, counts[row])
    total = span.astype(np.uint64) * _PLACES[63]
    for k in range(size):
        inside = k < span
        total[inside] += _mix(words[begin[inside] + k] + np.uint64(k)) * _PLACES[k]
    total = _mix(total)
    order = np.lexsort((total, row))
    total, row = total[order], row[order]
    fresh = np.append(True, (total[1:] != total[:-1]) | (row[1:] != row[:-1])) if len(total) else np.zeros(0, bool)
    return total[fresh], np.append(0, np.cumsum(np.bincount(row[fresh], minlength=n)))


def _planes(minima: np.ndarray) -> np.ndarray:
    """Low bits of [text, MINIMA] minima as BITS planes of two 64-bit words."""
    low = (minima ^ (minima >> np.uint64(29))).astype(np.uint8)
    packed = [np.packbits((low >> b) & 1, axis=1).view(">u8").astype(np.uint64) for b in range(BITS)]
    return np.concatenate(packed, axis=1).view(np.int64)


def _signatures(size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(low, ROWS_AT_ONCE)
                sets, bounds = shingle_sets(rows.column(1), size)
                n = np.diff(bounds)
                filled = np.flatnonzero(n)
                minima = np.zeros((rows.num_rows, MINIMA), np.uint64)
                digest = np.zeros((rows.num_rows, 2), np.uint64)
                if len(filled):
                    starts = bounds[:-1][filled]
                    for j, factor in enumerate(_FACTORS):
                        minima[filled, j] = np.minimum.reduceat(sets * factor, starts)
                    for j in (0, 1):
                        digest[filled, j] = np.add.reduceat(_mix(sets + _PLACES[50 + j]), starts)
                bands = minima.reshape(-1, BANDS, ROWS)
                keys = _mix(sum(_mix(bands[:, :, r]) * _PLACES[r] for r in range(ROWS)) + np.arange(BANDS, dtype=np.uint64) * _PLACES[40])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel().view(np.int64)))
                planes = _planes(minima)
                packed = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, planes.size + 1, planes.shape[1], dtype=np.int32)), pa.array(np.ascontiguousarray(planes).ravel())
                )
                columns = [rows.column(0), pa.array(n), *(pa.array(digest[:, j].view(np.int64)) for j in (0, 1)), packed, lists]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "d1", "d2", "sig", "bands"])
        pretokens.give_back()

    return sign


def _sets(size: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(low, ROWS_AT_ONCE)
                sets, bounds = shingle_sets(rows.column(1), size)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([rows.column(0), lists], names=["rep", "set"])
        pretokens.give_back()

    return make


def estimates(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures: share of equal minima, corrected for chance collisions."""
    words = MINIMA // 64
    unequal = np.zeros(len(others), np.int64)
    for w in range(words):
        differ = np.zeros(len(others), np.uint64)
        for plane in range(BITS):
            differ |= others[:, plane * words + w] ^ one[..., plane * words + w]
        unequal += np.bitwise_count(differ)
    return (1 - unequal / MINIMA - CHANCE) / (1 - CHANCE)


def _signature_rows(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().view(np.uint64).reshape(-1, BITS * MINIMA // 64)


def _hang_together(sig: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Edges of a search over one bucket: each member from the one that first reached it."""
    edges, rest = [], np.arange(len(sig))
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            one = queue.pop()
            near = estimates(sig[one], sig[rest]) >= least
            edges += [(one, k) for k in rest[near]]
            queue += list(rest[near])
            rest = rest[~near]
    return edges


def _bucket_edges(least: float):
    """For rows sorted by (bucket, slice): edges (a, b) of each bucket slice's search."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def edges(rows: pa.Table) -> pa.RecordBatch:
            group = np.stack([rows.column(0).to_numpy(), rows.column(1).to_numpy()])
            rep, sig = rows.column(2).to_numpy(), _signature_rows(rows.column(3))
            first = np.flatnonzero(np.append(True, (group[:, 1:] != group[:, :-1]).any(axis=0)))
            size = np.diff(np.append(first, len(rep)))
            lead = np.repeat(first, size)
            near = estimates(sig[lead], sig) >= least
            done = np.minimum.reduceat(near.astype(int), first).astype(bool) | (size == 2)
            star = np.repeat(done, size) & near & (np.arange(len(rep)) != lead)
            a, b = [rep[lead[star]]], [rep[star]]
            for start, n in zip(first[~done], size[~done], strict=True):
                found = np.array(_hang_together(sig[start : start + n], least), np.int64).reshape(-1, 2)
                a.append(rep[start + found[:, 0]])
                b.append(rep[start + found[:, 1]])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            # The last group may go on in the next batch: hold it back.
            key = [batch.column(0).to_numpy(), batch.column(1).to_numpy()]
            change = np.flatnonzero((key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])) + 1
            cut = change[-1] if len(change) else 0
            same = held and (held[-1].column(0)[-1], held[-1].column(1)[-1]) == (batch.column(0)[0], batch.column(1)[0])
            if cut or (held and not same):
                ready = [*held, batch.slice(0, cut)] if cut else held
                yield edges(pa.Table.from_batches(ready))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield edges(pa.Table.from_batches(held))
        pretokens.give_back()

    return search


def _confirmed(percent: int, least: float):
    """For one family slice pair: links that join its parts, confirmed on full sets."""

    def confirm(table: pa.Table) -> pa.Table:
        rep, part = table.column("rep").to_numpy(), table.column("part").to_numpy()
        sig = _signature_rows(table.column("sig"))
        column = table.column("set").combine_chunks()
        bounds = column.offsets.to_numpy()
        flat = column.values.to_numpy().view(np.uint64)
        sets = [flat[x:y] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
        sizes = np.diff(bounds)
        low, high = part.min(), part.max()
        root = np.arange(len(rep))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        near_a, near_b, near = [], [], []
        for k in range(len(rep)):
            other = np.arange(k + 1, len(rep))
            if low != high:
                other = other[part[other] != part[k]]
            smaller, larger = np.minimum(sizes[k], sizes[other]), np.maximum(sizes[k], sizes[other])
            other = other[100 * smaller >= percent * larger]
            found = estimates(sig[k], sig[other])
            other, found = other[found >= least], found[found >= least]
            near_a.append(np.full(len(other), k, np.int32))
            near_b.append(other.astype(np.int32))
            near.append(found.astype(np.float32))
        one, two = np.concatenate(near_a), np.concatenate(near_b)
        a, b = [], []
        for place in np.argsort(-np.concatenate(near), kind="stable"):
            x, y = int(one[place]), int(two[place])
            p, q = find(x), find(y)
            if p == q:
                continue
            common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if 100 * common >= percent * (int(sizes[x]) + int(sizes[y]) - common):
                root[max(p, q)] = min(p, q)
                a.append(rep[x])
                b.append(rep[y])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return confirm


def _slice_pairs(slices: Column, own: Column) -> Column:
    """The slice pairs (low, high) that a row of slice ``own`` takes part in."""
    every = F.sequence(F.lit(0), slices - 1)
    return F.transform(every, lambda k: F.struct(F.least(k, own).alias("low"), F.greatest(k, own).alias("high")))


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """Rows (id, n_shingles, component_id, kept), one for each input row.

    Words are runs of characters other than ASCII white space, A-Z lower-cased. Two
    documents are linked if 100 * common shingles >= percent * all shingles of both;
    a text of fewer words than a shingle is one shingle, one without words has none
    and is linked with nothing. ``component_id`` is the smallest id reachable by
    links, ``kept`` whether that is the row's own.

    Ids are integers. Rows that repeat an id are one document: its links are those
    of all its texts. A row without id is linked with nothing: component null, kept.
    A pair at the threshold escapes the bands with a chance of 5e-8. Tables between
    the steps are written to shared scratch; a lost executor costs single tasks.
    """
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = settle(
        named.mapInArrow(
            _signatures(shingle_words), "id long, n long, d1 long, d2 long, sig array<bigint>, bands array<bigint>"
        ),
        "signatures",
    )
    usable = signed.where((F.col("n") > 0) & F.col("id").isNotNull())
    classes = settle(
        usable.groupBy("n", "d1", "d2").agg(F.min("id").alias("rep"), F.first("sig").alias("sig"), F.first("bands").alias("bands")), "classes"
    )
    texts = named.where(F.col("id").isNotNull())
    signatures = classes.select("rep", "sig")

    least = percent / 100 - SLACK
    spread = classes.select("rep", F.explode("bands").alias("bucket"))
    crowded = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > 1)
    slices = F.ceil(F.col("m") / SLICE_ROWS).cast("int")
    members = spread.join(crowded, "bucket").join(signatures, "rep")
    # A bucket beyond SLICE_ROWS is searched by pairs of slices; nearly all are one slice.
    members = members.select("bucket", F.explode(_slice_pairs(slices, F.pmod(F.hash("rep"), slices))).alias("s"), "rep", "sig")
    members = members.select("bucket", (F.col("s.low") * (1 << 16) + F.col("s.high")).alias("slice"), "rep", "sig")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    searched = members.repartition(parts, "bucket", "slice").sortWithinPartitions("bucket", "slice", "rep")
    candidates = searched.mapInArrow(_bucket_edges(least), "a long, b long")
    families = settle(components(candidates), "families")

    texts = named.join(families, F.col("id") == F.col("node"), "left_semi")
    sets = settle(texts.mapInArrow(_sets(shingle_words), "rep long, set array<bigint>"), "sets")
    whole = sets.join(families.select(F.col("node").alias("rep"), F.col("component").alias("family")), "rep").join(signatures, "rep")
    weights = whole.groupBy("family").agg(F.count(F.lit(1)).alias("m"), F.sum(F.size("set")).alias("shingles"))
    cuts = F.greatest(F.ceil(F.col("m") / SLICE_ROWS), F.ceil(F.col("shingles") / SLICE_SHINGLES)).cast("int")
    dealt = whole.join(weights.select("family", cuts.alias("slices")), "family").withColumn("part", F.pmod(F.hash("rep"), "slices"))
    dealt = dealt.withColumn("s", F.explode(_slice_pairs(F.col("slices"), F.col("part"))))
    grouped = dealt.select("family", F.col("s.low").alias("low"), F.col("s.high").alias("high"), "part", "rep", "sig", "set")
    links = grouped.groupBy("family", "low", "high").applyInArrow(_confirmed(percent, least), "a long, b long")

    # Rows that repeat an id tie the classes of its texts together.
    repeated = usable.join(classes.select("n", "d1", "d2", "rep"), ["n", "d1", "d2"]).groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
    ties = repeated.where(F.col("a") != F.col("b")).select("a", "b")
    found = settle(components(links.unionByName(ties)), "components")
    labelled = classes.select("n", "d1", "d2", "rep").join(found, F.col("rep") == F.col("node"), "left")
    labelled = labelled.select("n", "d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    rows = signed.select("id", "n", "d1", "d2").join(labelled, ["n", "d1", "d2"], "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    rows = rows.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))
    return rows.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))

