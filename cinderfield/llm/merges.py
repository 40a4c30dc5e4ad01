"""Byte-pair merging of many sequences at once.

Sequences lie one after another in flat arrays (ragged rows). In each round
every sequence applies its own lowest-rank pair; those without a pair left the
arrays before. The result equals merging one pair at a time.
"""

from __future__ import annotations

import base64
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NEVER = np.iinfo(np.int32).max


@dataclass(frozen=True)
class MergeTable:
    """Pairs by key (left id * size + right id), ascending, with their rank and merged id."""

    size: int
    byte_ids: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    stepwise: np.ndarray  # ids that can start a pair of lower rank than the one that made them
    whole: pa.Array | None  # token bytes by id, where a piece that is a token is taken as it is

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Row of each pair in the table, or NEVER's stand-in -1."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, at, -1)


def _table(size: int, byte_ids: np.ndarray, pairs: np.ndarray, ranks: np.ndarray, merged: np.ndarray, whole) -> MergeTable:
    keys = pairs[:, 0].astype(np.int64) * size + pairs[:, 1]
    order = np.argsort(keys, kind="stable")
    made = np.full(size, -1, np.int64)  # the highest rank that makes an id
    np.maximum.at(made, merged, ranks)
    stepwise = np.zeros(size, bool)
    for side in (0, 1):
        stepwise[pairs[ranks <= made[pairs[:, side]], side]] = True
    return MergeTable(
        size, byte_ids.astype(np.int32), keys[order], ranks[order].astype(np.int32), merged[order].astype(np.int32), stepwise, whole
    )


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by id, of a file with one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens: list[bytes] = [b""] * (1 + max(int(rank) for _, rank in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def from_ranks(tokens: list[bytes]) -> MergeTable:
    """Any two neighbours merge whose bytes together are a token; its id is the rank."""
    ids = {t: i for i, t in enumerate(tokens) if t}
    pairs, merged = [], []
    for token, i in ids.items():
        for cut in range(1, len(token)):
            left, right = ids.get(token[:cut]), ids.get(token[cut:])
            if left is not None and right is not None:
                pairs.append((left, right))
                merged.append(i)
    byte_ids = np.array([ids[bytes([b])] for b in range(256)])
    made = np.array(merged)
    return _table(len(tokens), byte_ids, np.array(pairs), made, made, pa.array(tokens, pa.binary()))


def byte_characters() -> dict[int, str]:
    """The published byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in names:
            names[b] = chr(256 + len(names) - len(shown))
    return names


def read_json(path: str) -> tuple[MergeTable, list[str]]:
    """Merge table of a byte-level BPE in the tokenizers format, and its added tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = spec["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    names = byte_characters()
    pairs = np.array([(vocab[a], vocab[b]) for a, b in merges])
    merged = np.array([vocab[a + b] for a, b in merges])
    byte_ids = np.array([vocab[names[b]] for b in range(256)])
    size = 1 + max(vocab.values())
    table = _table(size, byte_ids, pairs, np.arange(len(merges)), merged, None)
    return table, [t["content"] for t in spec["added_tokens"]]


def encode(words: pa.Array, table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after another, and how many each word has."""
    n = len(words)
    bounds = np.frombuffer(words.buffers()[1], np.int32, n + 1, words.offset * 4)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    lengths = np.diff(bounds).astype(np.int64)
    counts = np.zeros(n, np.int64)
    ids_done: list[np.ndarray] = []
    rows_done: list[np.ndarray] = []

    def finish(sym: np.ndarray, row: np.ndarray) -> None:
        ids_done.append(sym)
        rows_done.append(row)

    sym = table.byte_ids[data]
    row = np.repeat(np.arange(n, dtype=np.int32), lengths)
    if table.whole is not None and n:
        known = pc.index_in(words, value_set=table.whole).to_numpy(zero_copy_only=False)
        hit = ~np.isnan(known) if known.dtype.kind == "f" else np.ones(n, bool)
        hit &= lengths > 0
        finish(known[hit].astype(np.int32), np.flatnonzero(hit).astype(np.int32))
        live = ~hit[row]
        sym, row = sym[live], row[live]
    at = np.full(len(sym), -1)  # row in the table of the pair that starts here
    if len(sym) > 1:
        at[:-1] = table.rank_of(sym[:-1], sym[1:])
        at[:-1][row[:-1] != row[1:]] = -1
    ranks = np.append(table.ranks, NEVER)  # index -1: no pair
    while len(sym):
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        size = np.diff(np.append(first, len(row)))
        rank = ranks[at]
        lowest = np.minimum.reduceat(rank, first)
        over = lowest == NEVER
        if over.any():
            gone = np.repeat(over, size)
            finish(sym[gone], row[gone])
            stay = ~gone
            sym, row, at, rank = sym[stay], row[stay], at[stay], rank[stay]
            lowest, size = lowest[~over], size[~over]
            if not len(sym):
                break
        chosen = np.flatnonzero(rank == np.repeat(lowest, size))
        new = table.merged[at[chosen]]
        # Of touching pairs (aaa) every second one merges; a stepwise id only at its first place.
        index = np.arange(len(chosen))
        opens = np.append(True, chosen[1:] != chosen[:-1] + 1)
        use = (index - np.maximum.accumulate(np.where(opens, index, 0))) % 2 == 0
        leading = np.append(True, row[chosen[1:]] != row[chosen[:-1]])
        use &= leading | ~table.stepwise[new]
        chosen, new = chosen[use], new[use]
        sym[chosen] = new
        keep = np.ones(len(sym), bool)
        keep[chosen + 1] = False
        place = chosen - np.arange(len(chosen))  # each merge before removed one symbol
        sym, row, at = sym[keep], row[keep], at[keep]
        again = np.concatenate([place, place[place > 0] - 1])
        again = again[again < len(sym) - 1]
        at[again] = np.where(row[again] == row[again + 1], table.rank_of(sym[again], sym[again + 1]), -1)
        if len(sym):
            at[-1] = -1
    if not ids_done:
        return np.zeros(0, np.int32), counts
    ids, rows = np.concatenate(ids_done), np.concatenate(rows_done)
    counts += np.bincount(rows, minlength=n)
    return ids[np.argsort(rows, kind="stable")], counts
