"""Byte-level pre-tokens of whole texts, found with array operations.

The rule is the published pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
A regular-expression engine needs more than a microsecond per match; here a
slice of many texts is classified character by character in numpy and the
boundaries follow from the runs of equal classes.
"""

from __future__ import annotations

import ctypes
import gc
import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
SLICE_BYTES = 3 << 20

# The code points of the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

_CUT = re.compile(rb"[A-Za-z](?= [A-Za-z])")


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point."""
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for run in regex.findall(pattern, every):
            table[np.frombuffer(run.encode("utf-32-le"), np.uint32)] = kind
    table[WHITE_SPACE] = SPACE
    return table


def _starts(points: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Positions at which a pre-token starts. doc_starts: first positions of non-empty texts."""
    n = len(points)
    kind = char_classes()[points]
    edge = np.empty(n, bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge[doc_starts] = True
    first = np.flatnonzero(edge)
    end = np.append(first[1:], n)
    run_kind = kind[first]
    opens = np.zeros(n + 1, bool)
    opens[doc_starts] = True
    opens[n] = True
    last_of_doc = opens[end]  # no further character in the same text
    opens = opens[:n]
    first_of_doc = opens[first]

    space = run_kind == SPACE
    ends_blank = points[end - 1] == 32
    start = np.zeros(n, bool)
    # A run of white space leaves its last character to what follows in the text.
    start[first[space & (last_of_doc | (end - first > 1))]] = True
    lone = space & ~last_of_doc
    start[end[lone] - 1] = True  # a token of its own, or the blank before a word
    glued = np.zeros(len(first), bool)
    glued[1:] = (space & ends_blank)[:-1]
    glued &= ~space & ~first_of_doc
    start[first[~space & ~glued]] = True

    # 's 't 'm 'd 're 've 'll: a lone apostrophe that starts a token, before a run of letters.
    quote = np.flatnonzero((points[first] == 39) & (end - first == 1) & ~glued & ~last_of_doc)
    quote = quote[run_kind[quote + 1] == LETTER] if len(quote) else quote
    if len(quote):
        at = first[quote] + 1
        c0 = points[at]
        more = end[quote + 1] - at > 1
        c1 = np.where(more, points[np.minimum(at + 1, n - 1)], 0)
        one = np.isin(c0, [ord(c) for c in "stmd"])
        two = (np.isin(c0, [ord("r"), ord("v")]) & (c1 == ord("e"))) | ((c0 == ord("l")) & (c1 == ord("l")))
        taken = np.where(one, 1, np.where(two, 2, 0))
        hit = taken > 0
        start[at[hit]] = False
        rest = hit & (end[quote + 1] - at > taken)
        start[at[rest] + taken[rest]] = True
    return np.flatnonzero(start)


def split(data: bytes, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Pre-tokens of the texts ``data[offsets[i]:offsets[i + 1]]`` and how many each text has."""
    texts = len(offsets) - 1
    if not len(data):
        return pa.array([], pa.binary()), np.zeros(texts, np.int64)
    points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
    if len(points) == len(data):
        byte_at = None
        doc_at = offsets
    else:
        width = np.ones(len(points), np.int32)
        for limit in (0x80, 0x800, 0x10000):
            width += points >= limit
        byte_at = np.zeros(len(points) + 1, np.int32)
        np.cumsum(width, out=byte_at[1:])
        doc_at = np.searchsorted(byte_at, offsets)
    filled = doc_at[:-1][np.diff(doc_at) > 0]
    start = _starts(points, filled)
    counts = np.diff(np.searchsorted(start, doc_at))
    start_bytes = start if byte_at is None else byte_at[start]
    bounds = np.append(start_bytes, len(data)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(data)]), counts


def give_back() -> None:
    """Return freed memory to the system: Spark keeps idle workers, and what they hold counts against the executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def slices(column: pa.Array, cut_at: re.Pattern[bytes] = _CUT, size: int | None = None) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """The texts of a string column, null as empty, in pieces of about SLICE_BYTES.

    Yields the joined bytes, the bounds of the pieces in them, and the row of
    each piece. A longer text is cut where a match of ``cut_at`` ends: before a blank
    between two letters, where a pre-token begins whatever stands around it.
    """
    size = size or SLICE_BYTES
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = (column.fill_null("") if column.null_count else column).cast(pa.large_string())
    _, bounds, values = column.buffers()
    ends = np.frombuffer(bounds, np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    data, low = memoryview(values or b""), 0
    while low < len(column):
        start = ends[low]
        high = int(np.searchsorted(ends, start + size, "right")) - 1
        if high > low:
            yield bytes(data[start : ends[high]]), ends[low : high + 1] - start, np.arange(low, high)
            low = high
            continue
        at, stop = int(start), int(ends[low + 1])
        while at < stop:
            cut = cut_at.search(data, at + size, stop) if stop - at > size else None
            end = cut.end() if cut else stop
            yield bytes(data[at:end]), np.array([0, end - at]), np.array([low])
            at = end
        low += 1
