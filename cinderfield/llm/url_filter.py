"""URL rules and blocked hosts in a sorted digest array (operator 10)."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"
MOST_BYTES = 1 << 30


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, SPLIT, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, SPLIT, 2), F.lit(""))


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def pack(entries: Iterable[str]) -> bytes:
    """Sorted 64-bit xxhash keys, the bounds of the full strings, and the strings, as one byte block."""
    found = sorted({e.encode() for e in entries}, key=lambda e: (xxhash.xxh64_intdigest(e), e))
    keys = np.array([xxhash.xxh64_intdigest(e) for e in found], np.uint64)
    bounds = np.append(0, np.cumsum([len(e) for e in found])).astype(np.uint64)
    return np.array([len(found)], np.uint64).tobytes() + keys.tobytes() + bounds.tobytes() + b"".join(found)


class DigestArray:
    """A packed block, memory-mapped from an unnamed file that goes when its process does."""

    def __init__(self, block: bytes):
        file = tempfile.TemporaryFile()
        file.write(block)
        file.flush()
        self.data = np.memmap(file, np.uint8, "r")
        n = int(self.data[:8].view(np.uint64)[0])
        self.keys = self.data[8 : 8 + 8 * n].view(np.uint64)
        self.bounds = self.data[8 + 8 * n : 16 + 16 * n].view(np.uint64)
        self.strings = self.data[16 + 16 * n :]

    def contains(self, probes: Sequence[bytes]) -> np.ndarray:
        """Which probes are entries. A hit on the key counts only if the stored string is the same."""
        hit = np.zeros(len(probes), bool)
        if not len(self.keys) or not probes:
            return hit
        wanted = np.fromiter(map(xxhash.xxh64_intdigest, probes), np.uint64, len(probes))
        low, high = np.searchsorted(self.keys, wanted), np.searchsorted(self.keys, wanted, "right")
        for i in np.flatnonzero(high > low):
            hit[i] = any(self.string(k) == probes[i] for k in range(low[i], high[i]))
        return hit

    def string(self, k: int) -> bytes:
        return self.strings[int(self.bounds[k]) : int(self.bounds[k + 1])].tobytes()


@lru_cache(maxsize=4)
def _mapped(block: bytes) -> DigestArray:
    return DigestArray(block)


def _suffixes(host: str) -> list[str]:
    """The host and all domains above it."""
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(len(labels))]


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], blocked_hosts: Iterable[str], id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """Rows (id, host, path, rule, verdict), one for each input row.

    A rule fits its host and all subdomains where the path starts with the rule's.
    The longest fitting rule text decides (of equal ones the longer host). Without
    a rule a URL is blocked if its host or a domain above it is in ``blocked_hosts``,
    else allowed. Rules and hosts lie in sorted arrays of 64-bit digests that a
    worker maps into memory; each batch probes them by one vectorised binary
    search, and every hit is confirmed on the stored string.

    The packed lists are broadcast and must stay under 1 GB. There is no shuffle.
    A null URL or one without ``://`` has empty host and path, no rule, and is
    allowed; repeated rows and null ids give their own rows; other columns are ignored.
    """
    spark = pages.sparkSession
    verdicts = {r.text: r.verdict for r in rules}
    if len(verdicts) != len(rules):
        raise ValueError("two rules with the same host and path")
    blocks = (pack(verdicts), pack(blocked_hosts))
    if sum(map(len, blocks)) > MOST_BYTES:
        raise ValueError("the lists exceed what may be broadcast; split them by host and judge in parts")
    shared = spark.sparkContext.broadcast((*blocks, verdicts, sorted({len(r.path) for r in rules})))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule_block, host_block, verdict_of, lengths = shared.value
        rule_array, host_array = _mapped(rule_block), _mapped(host_block)
        for batch in batches:
            probes, owner, domains, domain_owner = [], [], [], []
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for row, (host, path) in enumerate(zip(hosts, paths, strict=True)):
                for domain in _suffixes(host) if host else ():
                    domains.append(domain.encode())
                    domain_owner.append(row)
                    for n in lengths:
                        if len(path) >= n:
                            probes.append((domain + path[:n]).encode())
                            owner.append(row)
            best: list[str | None] = [None] * len(hosts)
            for i in np.flatnonzero(rule_array.contains(probes)):
                # Candidates of a row come with falling host length, so a later equal text length never wins.
                text, row = probes[i].decode(), owner[i]
                if best[row] is None or len(text) > len(best[row]):
                    best[row] = text
            bad = np.zeros(len(hosts), bool)
            hit = host_array.contains(domains)
            bad[np.array(domain_owner, int)[hit]] = True
            verdict = [verdict_of[b] if b is not None else "block" if x else "allow" for b, x in zip(best, bad, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best, pa.string()), pa.array(verdict, pa.string())], names=schema.names
            )

    text = [T.StructField(n, T.StringType()) for n in ("host", "path", "rule", "verdict")]
    schema = T.StructType([pages.schema[id_col], *text])
    parts = pages.select(F.col(id_col), host_of(F.col(url_col)), path_of(F.col(url_col))).toDF("id", "host", "path")
    return parts.mapInArrow(judge, schema)
