"""Registered queries of the training-data operators against SQL, public libraries or brute force."""

import collections
import hashlib
import html
import re

import duckdb
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from cinderfield.llm import bpe_codec, line_dedup, merges, registry

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def tokens():
    ranks = {t: i for i, t in enumerate(merges.read_ranks(RANKS)) if t}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def digest(ids):
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = con.execute(registry.ORACLES[name]).df()
    got = registry.REGISTRY[name](spark, sf).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    got, want = (d[columns].sort_values(columns).reset_index(drop=True) for d in (got, want))
    assert len(got) == len(want) > 0
    for c in columns:
        assert ((got[c] == want[c]) | (got[c].isna() & want[c].isna())).all(), c


def test_thirteen_queries_and_pipeline_are_registered():
    import __spark_entry__

    found = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in found) == 1
    assert found["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("chunk", [bpe_codec.CHUNK_BYTES, 20_000, 300])
def test_codec_equals_library(spark, sf, tokens, chunk):
    """The query at sf0.01; smaller chunks give records of which all words are known."""
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    docs = docs if chunk > 300 else docs.where("length(text) < 300")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = bpe_codec.digests(docs, RANKS, chunk_bytes=chunk).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = tokens.encode_ordinary(texts[r["doc_id"]])
        plain = hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), digest(ids), plain)


def test_counts_equal_library(spark, sf, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = registry.REGISTRY["op6_token_counts"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 512)


def test_language_of_held_out_rows(spark, sf):
    found = registry.REGISTRY["op1_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").toPandas()
    assert len(found) == 200 and found["score"].between(0, 1).all()
    held = found[found["held_out"]]
    assert len(held) > 20 and (held["lang"] == held["lang_pred"]).mean() > 0.95


def test_quality_of_held_out_rows(spark, sf):
    found = registry.REGISTRY["op9_quality_classifier"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert found["score"].between(0, 1).all() and ((found["score"] >= 0.5) == (found["predicted"] == 1)).all()
    held = found[found["held_out"]]
    assert len(held) > 20 and (held["quality"] == held["predicted"]).mean() > 0.9


def test_main_text_of_pages(spark, sf):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = registry.REGISTRY["op3_html_extraction"](spark, sf).collect()
    assert len(rows) == len(pages)
    right = 0
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = (re.sub(r"<[^>]*>", "", p.replace("<br>", " ")) for p in re.split(r"</?(?:p|h1)>", article))
        blocks = [" ".join(html.unescape(p).split()) for p in parts]
        right += r["text"] == "\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])
    assert right / len(rows) > 0.95


def sets_of(texts, size):
    out = {}
    for doc, text in texts.items():
        words = WORDS.findall((text or "").translate(LOWER))
        out[doc] = frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()
    return out


def roots_of(sets):
    """Smallest reachable document, by comparing all pairs."""
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    docs = sorted(d for d in sets if sets[d])
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            common = len(sets[a] & sets[b])
            if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


def brute_pipeline(rows, items, tokens):
    docs = {d: (text, source) for d, text, source in rows if text and any(c.isalpha() for c in text)}
    sites = collections.defaultdict(set)
    for text, source in docs.values():
        for line in text.split("\n"):
            if WORDS.search(line):
                sites[line.strip(" ")].add(source)
    bad = {x for x, found in sites.items() if len(found) >= (line_dedup.LONG_SITES if len(WORDS.findall(x)) > 50 else line_dedup.MIN_SITES)}
    texts = {}
    for d, (text, _) in docs.items():
        cut = "\n".join(line for line in text.split("\n") if line.strip(" ") not in bad)
        texts[d] = cut if WORDS.search(cut) else text
    roots = roots_of(sets_of(texts, 5))
    texts = {d: t for d, t in texts.items() if roots[d] == d}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for item in items:
        words = word.findall(item.translate(LOWER))
        n = min(13, len(words))
        windows |= {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
    out = {}
    for d, text in texts.items():
        words, hit = word.findall(text.translate(LOWER)), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    hit.update(range(i, i + n))
        if not (hit and 20 * len(hit) >= len(words)):
            out[d] = tokens.encode_ordinary(text)
    return out


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_pipeline_equals_brute_force(spark, sf, tokens, size):
    sf = sf.replace("0.001", size)
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = brute_pipeline(docs, items, tokens)
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == {d: (len(ids), digest(ids)) for d, ids in want.items()}
    assert 0 < len(got) < len(docs)
