"""Main text of pages by a recurrent block labeller (operator 3)."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderfield.llm.html_blocks import Block, Node, node_of, read_blocks

PATH_SIZE, WORD_SIZE, FACTS = 256, 32, 8
INPUT, HIDDEN = PATH_SIZE + WORD_SIZE + FACTS, 16
SAMPLE_PAGES = 200
CHARS_PER_PAGE = 60_000
TRAIN_BLOCKS = 80
WINDOW, CONTEXT = 8192, 256  # a page of more blocks is labelled in stretches that see so many of their neighbours
BATCH = 128
RESULT = "struct<text: string, n_blocks: int, n_kept: int>"

#: Elements and names that tell main text from the rest; seeds of the training labels.
MAIN = frozenset("article main post entry content story body text".split())
ASIDE = frozenset(
    "nav header footer aside form menu sidebar ad ads advert advertisement banner cookie notice comment comments share social related "
    "breadcrumb breadcrumbs newsletter promo widget subscribe pagination login search sponsored sponsor promoted copyright disclaimer".split()
)
#: Elements of the HTML standard that stand beside an article.
NEVER_MAIN = frozenset("form nav footer aside menu dialog button label".split())
MAIN_WRAPS = ["article", "main", "div post", "div entry content", "section article body", "div content", "div story", "div text", "div main", "section", "div", ""]
ASIDE_WRAPS = [f"div {name}" for name in sorted(ASIDE - {"nav", "header", "footer", "aside", "form"})] + [
    "nav", "header", "footer", "aside", "form", "nav menu", "footer site", "header site", "aside sidebar", "section comments", "ul menu", "section related",
]
KEPT_TAGS = frozenset("p h1 h2 h3 li blockquote pre b".split())
MAIN_TAILS = [("p",), ("p",), ("p", "b"), ("h1",), ("h2",), ("h3",), ("ul", "li"), ("ol", "li"), ("blockquote", "p"), ("div", "p"), ("div",), ("table", "tr", "td"), ()]
ASIDE_TAILS = [("ul", "li", "a"), ("li", "a"), ("a",), ("p",), (), ("ul", "li"), ("span",), ("div", "p"), ("div",), ("h1",), ("h2",), ("h3",), ("label",), ("button",)]


@lru_cache(maxsize=50_000)
def _slots(label: str) -> tuple[int, list[int]]:
    tag, *names = label.split()
    return zlib.crc32(f"<{tag}".encode()) % PATH_SIZE, [zlib.crc32(name.encode()) % PATH_SIZE for name in names]


class _Path:
    """Hashed tags and names of a block's path; tags count more the further in they stand.

    Kept as sums while it moves from block to block, so a block costs the elements
    that opened and closed since the last one, however deep it stands.
    """

    def __init__(self):
        self.node: Node | None = None
        self.tags, self.deep, self.names = (np.zeros(PATH_SIZE, np.int64) for _ in range(3))

    def _count(self, node: Node, sign: int) -> None:
        tag, names = _slots(node.label)
        self.tags[tag] += sign
        self.deep[tag] += sign * node.depth
        for name in names:
            self.names[name] += sign

    def move(self, to: Node | None) -> np.ndarray:
        here, there, entered = self.node, to, []
        while here is not there:
            if there is None or (here is not None and here.depth >= there.depth):
                self._count(here, -1)
                here = here.parent
            else:
                entered.append(there)
                there = there.parent
        for node in entered:
            self._count(node, 1)
        self.node = to
        return 0.5 * self.tags + 0.5 * self.deep / max(1, to.depth if to else 1) + self.names


def features(blocks: list[Block], first: int = 0, total: int | None = None) -> np.ndarray:
    """[block, INPUT]: path, hashed words, and facts of length, links, marks and place among ``total`` blocks of the page."""
    out = np.zeros((len(blocks), INPUT), np.float32)
    path, total = _Path(), total or len(blocks)
    for i, block in enumerate(blocks):
        out[i, :PATH_SIZE] = path.move(block.node)
        words = block.text.lower().split()
        slots = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) for w in words), np.int64, len(words)) % WORD_SIZE
        counted = np.bincount(slots, minlength=WORD_SIZE)
        out[i, PATH_SIZE : PATH_SIZE + WORD_SIZE] = counted / max(1.0, float(np.sqrt((counted**2).sum())))
        size = max(1, len(block.text))
        out[i, PATH_SIZE + WORD_SIZE :] = (
            np.log1p(size) / 5, np.log1p(len(words)) / 4, min(1.0, block.linked / size), block.text[-1:] in tuple(".!?"),
            min(3.0, 20 * sum(map(block.text.count, ".,;")) / size), (first + i) / total, "©" in block.text, min(block.depth, 64) / 8,
        )
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Forward and backward LSTM (input, recurrent, bias) and the output layer."""

    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, *self.bias, self.out, self.out_bias]


def new_labeller() -> Labeller:
    random = np.random.default_rng(5)

    def draw(rows, columns):
        return random.normal(0, 1 / np.sqrt(rows), (rows, columns)).astype(np.float32)

    bias = np.zeros(4 * HIDDEN, np.float32)
    bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
    return Labeller(
        [draw(INPUT, 4 * HIDDEN) for _ in "fb"], [draw(HIDDEN, 4 * HIDDEN) for _ in "fb"], [bias.copy() for _ in "fb"],
        draw(2 * HIDDEN, 1)[:, 0], np.zeros(1, np.float32),
    )


def _run(x: np.ndarray, wx: np.ndarray, wh: np.ndarray, b: np.ndarray, keep: bool = False):
    """Hidden states [time, page, HIDDEN] of one direction; with ``keep`` also what the backward pass needs."""
    time, pages, _ = x.shape
    drive = x.reshape(time * pages, -1) @ wx + b
    drive = drive.reshape(time, pages, -1)
    h = c = np.zeros((pages, HIDDEN), np.float32)
    states = np.empty((time, pages, HIDDEN), np.float32)
    trace = []
    for t in range(time):
        z = drive[t] + h @ wh
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        if keep:
            trace.append((i, f, o, g, c, h))
        c = f * c + i * g
        h = o * np.tanh(c)
        states[t] = h
    return states, trace


def _back(x: np.ndarray, trace: list, dstates: np.ndarray, wh: np.ndarray):
    """Gradients of input, recurrent and bias weights of one direction."""
    time, pages, _ = x.shape
    dz = np.zeros((time, pages, 4 * HIDDEN), np.float32)
    dh_next = dc_next = np.zeros((pages, HIDDEN), np.float32)
    dwh = np.zeros_like(wh)
    for t in range(time - 1, -1, -1):
        i, f, o, g, c_before, h_before = trace[t]
        c = f * c_before + i * g
        tc = np.tanh(c)
        dh = dstates[t] + dh_next
        dc = dc_next + dh * o * (1 - tc**2)
        dz[t] = np.concatenate([dc * g * i * (1 - i), dc * c_before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g**2)], axis=1)
        dwh += h_before.T @ dz[t]
        dh_next, dc_next = dz[t] @ wh.T, dc * f
    flat = dz.reshape(time * pages, -1)
    return x.reshape(time * pages, -1).T @ flat, dwh, flat.sum(axis=0)


def _pad(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """[time, page, INPUT] padded at the end, the same with each page reversed, and [time, page] places of the reversal."""
    sizes = np.array([len(p) for p in pages])
    x = np.zeros((sizes.max(), len(pages), INPUT), np.float32)
    for k, page in enumerate(pages):
        x[: len(page), k] = page
    time = np.arange(sizes.max())[:, None]
    mirror = np.where(time < sizes, sizes - 1 - time, time)
    return x, x[mirror, np.arange(len(pages))], mirror


def _logits(pages: list[np.ndarray], m: Labeller, keep: bool = False):
    x, turned, mirror = _pad(pages)
    ahead, trace_a = _run(x, m.inputs[0], m.recurrent[0], m.bias[0], keep)
    back, trace_b = _run(turned, m.inputs[1], m.recurrent[1], m.bias[1], keep)
    back = back[mirror, np.arange(len(pages))]
    both = np.concatenate([ahead, back], axis=2)
    return both @ m.out + m.out_bias, (x, turned, mirror, both, trace_a, trace_b)


def train(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 10, step: float = 0.015) -> Labeller:
    """Cross-entropy by back-propagation through time, Adam, a fixed seed. A label of -1 is not asked."""
    m, random = new_labeller(), np.random.default_rng(9)
    first = [np.zeros_like(p) for p in m.parameters()]
    second = [np.zeros_like(p) for p in m.parameters()]
    turn = 0
    for epoch in range(epochs):
        rate = step * (1 - epoch / epochs)
        order = random.permutation(len(pages))
        for rows in np.array_split(order, max(1, len(pages) // 32)):
            part = [pages[r] for r in rows]
            out, (x, turned, mirror, both, trace_a, trace_b) = _logits(part, m, keep=True)
            want = np.full(out.shape, -1.0, np.float32)
            for k, r in enumerate(rows):
                want[: len(labels[r]), k] = labels[r]
            asked = want >= 0
            error = (np.where(asked, _sigmoid(out) - want, 0) / max(1, asked.sum())).astype(np.float32)
            dboth = error[:, :, None] * m.out
            column = np.arange(len(part))
            a = _back(x, trace_a, dboth[:, :, :HIDDEN], m.recurrent[0])
            b = _back(turned, trace_b, dboth[:, :, HIDDEN:][mirror, column], m.recurrent[1])
            slopes = [a[0], b[0], a[1], b[1], a[2], b[2], (both * error[:, :, None]).sum(axis=(0, 1)), error.sum(keepdims=True).ravel()]
            turn += 1
            for p, s, f, v in zip(m.parameters(), slopes, first, second, strict=True):
                np.clip(s, -1, 1, out=s)
                f += 0.1 * (s - f)
                v += 0.01 * (s**2 - v)
                p -= rate * (f / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-7)
    return m


def _windows(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """(first, end, from) of the stretches a page is labelled in, and where each one's own blocks begin; nearly always one."""
    if len(blocks) <= WINDOW:
        return [(0, len(blocks), 0)]
    return [(max(0, at - CONTEXT), min(len(blocks), at + WINDOW + CONTEXT), at) for at in range(0, len(blocks), WINDOW)]


def predict(pages: list[list[Block]], m: Labeller) -> list[np.ndarray]:
    """Whether each block of each page is main text. Stretches of similar length run together."""
    out = [np.zeros(len(blocks), bool) for blocks in pages]
    parts = sorted(((k, *w) for k, blocks in enumerate(pages) if blocks for w in _windows(blocks)), key=lambda p: p[2] - p[1])
    at = 0
    while at < len(parts):
        # Fewer pages at once where they are long: the padded array stays small.
        longest = parts[min(at + BATCH, len(parts)) - 1]
        group = parts[at : at + max(1, min(BATCH, 40_000 // (longest[2] - longest[1])))]
        logits, _ = _logits([features(pages[k][low:high], low, len(pages[k])) for k, low, high, _ in group], m)
        for column, (k, low, high, own) in enumerate(group):
            end = min(high, own + WINDOW)
            out[k][own:end] = logits[own - low : end - low, column] > 0
        at += len(group)
    for blocks, main in zip(pages, out, strict=True):
        main &= ~_outside(blocks)
    return out


def _outside(blocks: list[Block]) -> np.ndarray:
    """Blocks inside elements that hold no article by their nature, unless one kind of them holds most of the page's text."""
    inside: dict[Node | None, frozenset[str]] = {None: frozenset()}

    def kinds(node: Node | None) -> frozenset[str]:
        way = []
        while node not in inside:
            way.append(node)
            node = node.parent
        found = inside[node]
        for node in reversed(way):
            tag = node.label.split(" ", 1)[0]
            found = inside[node] = found | {tag} if tag in NEVER_MAIN else found
        return found

    each = [kinds(b.node) for b in blocks]
    size = np.array([len(b.text) for b in blocks], np.int64)
    out = np.zeros(len(blocks), bool)
    for tag in frozenset().union(*each):
        held = np.fromiter((tag in e for e in each), bool, len(each))
        if 2 * size[held].sum() <= size.sum():
            out |= held
    return out


def seed_label(block: Block) -> int:
    """1 main text, 0 not, -1 unknown, as the elements and names of the path tell."""
    names = {word for label in block.path for word in label.split()}
    if names & ASIDE:
        return 0
    return 1 if names & {"article", "main"} else -1


def training_pages(pages: list[list[Block]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The sample's pages as they are, and again with their parts under other wrappers.

    Main blocks keep their inner elements and move under another main wrapper or
    none; other blocks are put under wrappers of any kind of aside, so the labeller
    learns menus, notices, forms and comments that the sample does not show.
    """
    random = np.random.default_rng(3)
    ends = [blocks if len(blocks) <= TRAIN_BLOCKS else blocks[: TRAIN_BLOCKS // 2] + blocks[-TRAIN_BLOCKS // 2 :] for blocks in pages if blocks]
    plain = [(blocks, [seed_label(b) for b in blocks]) for blocks in ends]
    main = [b for blocks, labels in plain for b, y in zip(blocks, labels, strict=True) if y == 1]
    rest = [b for blocks, labels in plain for b, y in zip(blocks, labels, strict=True) if y == 0]
    made = list(plain)
    if main and rest:
        for blocks, labels in [*plain, *plain, *plain]:
            own = [b for b, y in zip(blocks, labels, strict=True) if y == 1] or main[:3]
            wrap = MAIN_WRAPS[random.integers(len(MAIN_WRAPS))]
            base = (["html", "body"] if random.random() < 0.9 else []) + ([wrap] if wrap else [])
            inner = []
            for b in own:
                last = b.path[-1].split()[0] if b.path else "p"
                tail = (last,) if last in KEPT_TAGS and random.random() < 0.6 else MAIN_TAILS[random.integers(len(MAIN_TAILS))]
                inner.append((*base, *tail))
            # Headings and list items are short: the path has to tell them from menus.
            texts = [b.text if random.random() < 0.7 else " ".join(b.text.split()[: random.integers(1, 7)]) for b in own]
            inside = [(Block(text, node_of(path), 0), 1) for text, path in zip(texts, inner, strict=True)]
            for _ in range(random.integers(2, 7)):
                around = ASIDE_WRAPS[random.integers(len(ASIDE_WRAPS))]
                source = rest if random.random() < 0.6 else main  # comments and notices read like main text
                tail = ASIDE_TAILS[random.integers(len(ASIDE_TAILS))]
                outside = base if random.random() < 0.2 else ["html", "body"]
                group = []
                for _ in range(random.integers(1, 5)):
                    b = source[random.integers(len(source))]
                    group.append((Block(b.text, node_of((*outside, around, *tail)), len(b.text) if "a" in tail else 0), 0))
                place = random.choice([0, len(inside), random.integers(0, len(inside) + 1)], p=[0.4, 0.4, 0.2])
                inside[place:place] = group
            made.append(([b for b, _ in inside][:TRAIN_BLOCKS], [y for _, y in inside][:TRAIN_BLOCKS]))
            made.append(([Block(own[0].text, None, 0)], [1]))
    return [features(b) for b, _ in made], [np.array(y, np.float32) for _, y in made]


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> Labeller:
    """A labeller trained on a bounded sample of pages.

    Bound: ``sample_pages`` pages with the smallest hash of their id, of each the
    CHARS_PER_PAGE characters (of a longer page half from either end), and of those
    TRAIN_BLOCKS blocks, also from both ends. Labels come from what semantic elements and
    names say about the sample's blocks, and from the same blocks under other wrappers.
    """
    half = CHARS_PER_PAGE // 2
    ends = F.concat(F.substring(html_col, 1, half), F.substring(html_col, -half, half))
    whole = F.when(F.length(html_col) <= CHARS_PER_PAGE, F.col(html_col)).otherwise(ends)
    hashed = pages.where(F.col(html_col).isNotNull()).select(F.xxhash64(F.col(id_col).cast("string")).alias("h"), whole.alias("html"))
    # Hashes alone first: then only the sample's own pages travel, not a sample of each partition.
    last = hashed.select("h").orderBy("h").limit(sample_pages).agg(F.max("h")).first()[0]
    sample = hashed.where(F.col("h") <= F.lit(last).cast("long")).orderBy("h", "html").limit(sample_pages).collect()
    read = [read_blocks(row["html"]) for row in sample]
    return train(*training_pages(read)) if any(read) else new_labeller()


def extractor(pages: DataFrame, labeller: Labeller) -> Callable[[Column], Column]:
    """A column function: html to struct(text, n_blocks, n_kept).

    Every block of the whole page is read with its tag path and words; a
    bidirectional LSTM labels each in the context of all others; blocks labelled
    main text are joined by a line end in page order. Forms, navigation, footers and
    the like are left out whatever the labeller says, unless they hold most of the
    page. A page is read in time linear in its length, however deep; one of more than
    WINDOW blocks is labelled in overlapping stretches. Null and empty pages, and
    pages without visible text, give an empty text; repeated rows give the same each. There is no shuffle; the
    labeller has a fixed size and is broadcast.
    """
    shared = pages.sparkSession.sparkContext.broadcast(labeller)

    @F.arrow_udf(RESULT)
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for low in range(0, len(batch), 1000):
                read = [read_blocks(page or "") for page in batch.slice(low, 1000).to_pylist()]
                for blocks, main in zip(read, predict(read, shared.value), strict=True):
                    kept = [b.text for b, keep in zip(blocks, main, strict=True) if keep]
                    rows.append({"text": "\n".join(kept), "n_blocks": len(blocks), "n_kept": len(kept)})
            yield pa.array(rows, pa.struct([("text", pa.string()), ("n_blocks", pa.int32()), ("n_kept", pa.int32())]))

    return extract
