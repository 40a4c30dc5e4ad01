"""Language identification by cross-parsing entropy (operator 1)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderfield.llm import pretokens

DOCS_PER_LANGUAGE = 60
CHARS_PER_DOC = 700
LETTERS = 190  # letters with a symbol of their own; all others share SHARED symbols
SHARED = 60
PIECE = 256
UNDEFINED = "und"
RESULT = "struct<lang: string, score: double>"


@lru_cache(maxsize=1)
def _lower() -> np.ndarray:
    """Each letter's lower-case code point; 32 for everything else."""
    letters = np.flatnonzero(pretokens.char_classes() == pretokens.LETTER)
    table = np.full(len(pretokens.char_classes()), 32, np.uint32)
    table[letters] = [ord(low) if len(low := chr(c).lower()) == 1 else c for c in letters]
    return table


def normalise(points: np.ndarray) -> np.ndarray:
    """Lower-case letters; anything between them becomes one blank."""
    low = _lower()[points]
    blank = low == 32
    return low[~blank | np.append(True, ~blank[:-1])] if len(low) else low


def automaton(text: np.ndarray, symbols: int) -> np.ndarray:
    """Transitions [state, symbol] of the suffix automaton of ``text``, -1 where there is none."""
    follow: list[dict[int, int]] = [{}]
    length, link = [0], [-1]
    last = 0
    for c in text.tolist():
        here = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = here
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[q] == length[p] + 1:
                link[here] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = copy
                    p = link[p]
                link[q] = link[here] = copy
        last = here
    table = np.full((len(follow), symbols), -1, np.int32)
    for state, edges in enumerate(follow):
        for c, to in edges.items():
            table[state, c] = to
    return table


@dataclass(frozen=True)
class LanguageModel:
    """Per language the parser's step table and the weight of a phrase."""

    languages: list[str]
    symbol_of: dict[int, int]
    own: list[np.ndarray]  # each language's number for a symbol; all it lacks share one
    steps: list[np.ndarray]
    weights: np.ndarray


def build(samples: dict[str, list[str]]) -> LanguageModel:
    """Suffix automata of the sample texts of each language."""
    points = {
        lang: [normalise(np.frombuffer(t.encode("utf-32-le"), np.uint32)) for t in texts] for lang, texts in sorted(samples.items())
    }
    seen = Counter(c for texts in points.values() for t in texts for c in t.tolist())
    common = sorted(sorted(seen), key=lambda c: -seen[c])[:LETTERS]
    symbol_of = {c: 1 + SHARED + i for i, c in enumerate(common)}
    lookup = _symbols(symbol_of)  # symbol 0 fills up short pieces
    languages, own, steps, weights = [], [], [], []
    for lang, texts in points.items():
        text = np.concatenate([lookup[t] for t in texts]) if texts else np.zeros(0, np.uint8)
        if not len(text):
            continue
        present = np.unique(text)
        number = np.full(256, len(present) + 1, np.uint8)
        number[0] = 0
        number[present] = np.arange(1, len(present) + 1)
        symbols = len(present) + 2
        table = automaton(number[text], symbols)
        root = np.maximum(table[0], 0)
        step = np.where(table < 0, root[None, :], table) * symbols * 2 + (table < 0)
        step[0] |= 1  # at the root every symbol begins a phrase
        step[:, 0] = 0
        languages.append(lang)
        own.append(number)
        steps.append(step.astype(np.int32).ravel())
        weights.append(np.log2(len(text) + 2))
    return LanguageModel(languages, symbol_of, own, steps, np.array(weights))


def _symbols(symbol_of: dict[int, int]) -> np.ndarray:
    """Symbol of every code point."""
    table = (1 + np.arange(0x110000, dtype=np.uint32) % SHARED).astype(np.uint8)
    for point, symbol in symbol_of.items():
        table[point] = symbol
    return table


def phrases(symbols: np.ndarray, bounds: np.ndarray, model: LanguageModel) -> np.ndarray:
    """Phrases [language, text] that a greedy longest-match parse needs.

    Texts are parsed in pieces of PIECE symbols, all pieces in step: one gather
    in the step table moves every piece on by one symbol.
    """
    sizes = np.diff(bounds)
    pieces = -(-sizes // PIECE)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = bounds[:-1][owner] + nth * PIECE
    length = np.minimum(PIECE, bounds[1:][owner] - start)
    grid = np.zeros((PIECE, len(owner)), np.uint8)
    for offset, row in enumerate(grid):
        long = np.flatnonzero(length > offset)
        row[long] = symbols[start[long] + offset]
    out = np.zeros((len(model.languages), len(sizes)))
    for k, step in enumerate(model.steps):
        at = np.zeros(len(owner), np.int64)
        count = np.zeros(len(owner), np.int32)
        for row in model.own[k][grid]:
            at += row
            move = step[at]
            count += move & 1
            np.right_shift(move, 1, out=at, casting="unsafe")
        out[k] = np.bincount(owner, count, len(sizes))
    return out


def predict(column: pa.Array, model: LanguageModel) -> pa.Array:
    """Language and score of each text of a batch."""
    n = len(column)
    count, size = np.zeros((len(model.languages), n)), np.zeros(n)
    lookup = _symbols(model.symbol_of)
    for data, bounds, row in pretokens.slices(column):
        lengths = [len(data[a:b].decode("utf-8")) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
        low = _lower()[points]
        blank = low == 32
        first = np.zeros(len(points) + 1, bool)
        edges = np.append(0, np.cumsum(lengths))
        first[edges[:-1]] = True
        keep = ~blank | np.append(True, ~blank[:-1])[: len(low)] | first[: len(low)]
        kept = np.append(0, np.cumsum(keep))[edges]
        letters = np.append(0, np.cumsum(~blank))[edges]
        count_here = phrases(lookup[low[keep]], kept, model)
        for k in range(len(model.languages)):
            count[k] += np.bincount(row, count_here[k], n)
        size += np.bincount(row, np.diff(letters), n)
    if not model.languages:
        return pa.array([{"lang": UNDEFINED, "score": 0.0}] * n, _ARROW)
    cost = count * model.weights[:, None]
    best = np.argmin(cost, axis=0)
    ordered = np.sort(cost, axis=0)
    second = ordered[1] if len(ordered) > 1 else ordered[0] * 2
    defined = size > 0
    score = np.where(defined, 1 - ordered[0] / np.maximum(second, 1e-9), 0.0)
    names = np.where(defined, np.array(model.languages, object)[best], UNDEFINED)
    return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score)], ["lang", "score"])


_ARROW = pa.struct([("lang", pa.string()), ("score", pa.float64())])


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Automata of a bounded sample of labelled text per language.

    Bound: DOCS_PER_LANGUAGE texts, chosen by the hash of their id, and the first
    CHARS_PER_DOC characters of each. Rows without text or language are left out.
    """
    order = Window.partitionBy("lang").orderBy("rank", "text")
    sample = (
        labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
        .select(
            F.col(lang_col).alias("lang"),
            F.substring(text_col, 1, CHARS_PER_DOC).alias("text"),
            F.xxhash64(F.col(id_col).cast("string")).alias("rank"),
        )
        .withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= DOCS_PER_LANGUAGE)
    )
    texts: dict[str, list[str]] = {}
    for row in sample.orderBy("lang", "n").collect():
        texts.setdefault(row["lang"], []).append(row["text"])
    return build(texts)


def identifier(docs: DataFrame, model: LanguageModel) -> Callable[[Column], Column]:
    """A column function: text to struct(lang, score).

    The text is reduced to lower-case letters and blanks and parsed greedily, for
    each language, into the longest phrases that occur in the language's sample
    text (a walk in its suffix automaton). Phrases times the log of the sample's
    size is the cross-parsing entropy; the language with the least wins, of equal
    ones the first by name. ``score`` is 0 to 1: how far the second lies behind.

    Null texts and texts without a letter are ``und`` with score 0. Whole texts are
    parsed, in pieces of 256 symbols. The model is bounded by the sample and broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield predict(batch, shared.value)
        pretokens.give_back()

    return identify


def in_remainder(id_col: str, divisor: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % divisor == remainder, F.lit(False))
