"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from cinderfield.llm import (
    bpe_codec,
    decontamination,
    html_extraction,
    language_id,
    line_dedup,
    merges,
    minhash,
    pretokens,
    quality_fm,
    quality_rules,
    registry,
    token_counts,
    url_filter,
)
from cinderfield.llm.components import components
from cinderfield.llm.html_blocks import read_blocks

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
# Names that operators use themselves, as further columns of the input.
CLASH = "doc_id long, text string, lang string, source string, n_chars long, key string, n_words string, id string, row string, chunk int, kept int"
LONG = "word and " * 40_000


def table(spark, texts, ids=None, sources=None, langs=None):
    rows = [
        (
            ids[i] if ids else i, t, (langs or ["en"] * len(texts))[i], (sources or ["s"] * len(texts))[i], None if t is None else len(t),
            "k", "n", "i", "r", 1, None,
        )
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, CLASH)


ODD = [None, "", "   ", "\n\n", "x", "!!", "Ünïcode 漢字 😀", LONG, "a b c d e f g", "a b c d e f g", "don't 'll re 12"]


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, ODD, ids=[0, 1, 2, 3, 4, 5, 6, 7, 8, 8, None])


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def library():
    ranks = {t: i for i, t in enumerate(merges.read_ranks(RANKS)) if t}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_merges_equal_libraries_on_random_texts():
    rnd = random.Random(3)
    alphabet = [*"aaab  'strevmld\n\t!?.,12éß漢字 \xa0\x85\x1cİ😀''", "'s", "'re", "'ll", " '"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += ["a" * 3000, "'" * 77, " " * 300 + "x", "x" + " " * 300, "ab" * 2000, "\n\n \n"]
    own, other = library(), Tokenizer.from_file(JSON)
    for data, want in (
        (merges.from_ranks(merges.read_ranks(RANKS)), [own.encode_ordinary(t) for t in texts]),
        (merges.read_json(JSON)[0], [e.ids for e in other.encode_batch(texts, add_special_tokens=False)]),
    ):
        for raw, bounds, rows in pretokens.slices(pa.array(texts)):
            words, counts = pretokens.split(raw, bounds)
            ids, sizes = merges.encode(words, data)
            per_text = np.add.reduceat(np.append(sizes, 0), np.append(0, np.cumsum(counts))[:-1]) * (counts > 0)
            cuts = np.cumsum(per_text)[:-1]
            for row, found in zip(rows, np.split(ids, cuts), strict=True):
                assert found.tolist() == want[row], texts[row]


def test_long_texts_are_cut_where_tokens_begin(monkeypatch):
    monkeypatch.setattr(pretokens, "SLICE_BYTES", 50)
    text = "Some words, and 'more' of them; it's \n\n long  text. " * 20
    pieces = b"".join(data for data, _, _ in pretokens.slices(pa.array([text, None, ""])))
    assert pieces.decode() == text
    table_, added = merges.read_json(JSON)
    want = [len(Tokenizer.from_file(JSON).encode(text).ids), 0, 0]
    assert token_counts.batch_counts(pa.array([text, None, ""]), table_, added).tolist() == want


def test_special_strings_count_as_the_library_has_them():
    texts = ["a<|endoftext|>b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "<|endoftext"]
    own, other = merges.read_json(JSON), Tokenizer.from_file(JSON)
    assert token_counts.batch_counts(pa.array(texts), *own).tolist() == [len(other.encode(t, add_special_tokens=False).ids) for t in texts]


def test_codec_edges(odd, empty):
    rows = bpe_codec.digests(odd, RANKS).collect()
    own = library()
    want = sorted((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
                  for t in ODD for ids in [own.encode_ordinary(t or "")])
    assert sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows) == want
    assert sum(r["doc_id"] is None for r in rows) == 1 and sum(r["doc_id"] == 8 for r in rows) == 2
    assert bpe_codec.digests(empty, RANKS).count() == 0


def test_codec_refuses_rows_that_changed_between_reads():
    with pytest.raises(RuntimeError, match="changed"):
        bpe_codec._Words([]).ids(np.array([3]))


def test_counts_edges(odd, empty):
    rows = token_counts.count_tokens(odd, JSON).collect()
    assert len(rows) == len(ODD) and sorted(r["n_bytes"] for r in rows) == sorted(len((t or "").encode()) for t in ODD)
    assert token_counts.count_tokens(empty, JSON).count() == 0


def test_language_edges(spark, odd, empty):
    model = language_id.build({"en": ["the cat and the dog " * 20], "de": ["der hund und die katze " * 20]})
    identify = language_id.identifier(odd, model)
    found = odd.select("text", identify("text").alias("f")).collect()
    for r in found:
        undefined = not any(c.isalpha() for c in r["text"] or "")
        assert (r["f"]["lang"] == "und") == undefined and 0 <= r["f"]["score"] <= 1
    # Nothing to learn from: every text is undefined.
    nothing = language_id.fit(empty)
    assert {r[0]["lang"] for r in odd.select(language_id.identifier(odd, nothing)("text")).collect()} == {"und"}
    assert language_id.predict(pa.array(["the dog", "die katze und der hund"]), model).field("lang").to_pylist() == ["en", "de"]


def test_phrases_equal_a_plain_parse():
    train = "the cat and the dog and a bird"
    model = language_id.build({"x": [train]})
    lookup = language_id._symbols(model.symbol_of)
    for text in ("the dog", "zebra the", "and and and", "b"):
        symbols = lookup[language_id.normalise(np.frombuffer(text.encode("utf-32-le"), np.uint32))]
        plain, at = 0, 0
        while at < len(text):
            size = 1
            while at + size < len(text) and text[at : at + size + 1] in train:
                size += 1
            at, plain = at + size, plain + 1
        assert language_id.phrases(symbols, np.array([0, len(symbols)]), model)[0, 0] == plain


def test_extraction_reads_other_layouts(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    labeller = html_extraction.fit(pages)
    rows = [
        (1, '<body><div class="menu"><ul><li><a href=x>Home</a></li></ul></div><div class="content"><h1>Title here</h1><p>One &amp;\n two.<p>Three, '
            'with a <a href=q>link</a>.</div><div class="comments"><p>I like this a lot.</p></div><footer>&copy; x</footer>', "Title here\nOne & two.\nThree, with a link."),
        (2, None, ""), (3, "", ""), (4, "<script>var a = '<p>no</p>';</script><style>p{}</style><!-- <p>no</p> -->", ""), (5, "<p", ""),
    ]
    frame = spark.createDataFrame([(i, h) for i, h, _ in rows], "page_id long, html string")
    found = frame.select("page_id", html_extraction.extractor(frame, labeller)("html").alias("f")).collect()
    assert {r["page_id"]: r["f"]["text"] for r in found} == {i: t for i, _, t in rows}
    assert html_extraction.fit(pages.limit(0)) is not None


def test_blocks_of_broken_markup():
    assert [b.text for b in read_blocks("<ul><li>a<li>b</ul></div>tail<p>x<b>y<br>z<p>&lt;w")] == ["a", "b", "tail", "xy z", "<w"]
    assert [b.text for b in read_blocks("<head><title>no</title><body>yes")] == ["yes"]


def test_blocks_of_tags_with_a_missing_quote():
    assert [b.text for b in read_blocks('<p class="lead>text</p><p class="x">more</p>')] == ["text", "more"]
    assert [b.text for b in read_blocks("<p title=\"a > b\" data-x='1 < 2'>one</p><a href='x>two</a>")] == ["one", "two"]


def test_deep_pages_are_read_in_linear_time():
    import time

    begun = time.perf_counter()
    blocks = read_blocks("<div><p>x" * 60_000 + "</li>" * 60_000)
    html_extraction.features(blocks[:3000])
    assert len(blocks) == 60_000 and blocks[-1].depth == 60_001 and time.perf_counter() - begun < 10
    # Moving from block to block gives the sums of each path.
    small = read_blocks("<div class='a b'><p>x<p>y<ul><li>z</ul></div>tail<nav><a href=q>w</a></nav>")
    for block, row in zip(small, html_extraction.features(small), strict=True):
        plain = np.zeros(html_extraction.PATH_SIZE)
        for depth, label in enumerate(block.path, 1):
            tag, names = html_extraction._slots(label)
            plain[tag] += 0.5 + 0.5 * depth / len(block.path)
            np.add.at(plain, names, 1)
        assert np.allclose(row[: html_extraction.PATH_SIZE], plain)


def test_long_pages_are_labelled_in_stretches(monkeypatch):
    monkeypatch.setattr(html_extraction, "WINDOW", 50)
    labeller = html_extraction.new_labeller()
    pages = [read_blocks("<p>some words here." * n) for n in (0, 1, 50, 51, 333)]
    whole = [html_extraction._logits([html_extraction.features(p)], labeller)[0][:, 0] > 0 if p else [] for p in pages]
    for found, want in zip(html_extraction.predict(pages, labeller), whole, strict=True):
        assert len(found) == len(want) and (found == want).mean() > 0.9 if len(found) else True


def test_adverts_forms_and_footers_are_not_main_text(spark):
    labeller = html_extraction.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    article = "<p>The river rose again last night, and the town waited. Nobody slept much.</p>" * 3
    rows = [
        (1, f'<body><div class="post">{article}</div><div class="sponsored"><p>Buy now and save.</p></div>'),
        (2, f'<body><div class="post">{article}</div><form><p>Your name and your answer.</p></form>'),
        (3, f"<body><div class='post'>{article}</div><footer><p>All rights kept by us, 2020.</p></footer>"),
        (3, f"<body><form><div class='post'>{article}</div></form>"),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, html string, text string, n_kept int")
    found = [r[0]["text"] for r in frame.select(html_extraction.extractor(frame, labeller)("html")).collect()]
    kept = "\n".join(["The river rose again last night, and the town waited. Nobody slept much."] * 3)
    assert found == [kept] * 4
    assert frame.limit(0).select(html_extraction.extractor(frame, labeller)("html")).count() == 0


def test_line_dedup_edges(spark, empty):
    many = [f"own line {i}\n Shared by all \n\nmore of {i}" for i in range(10)]
    copies = ["whole copy of a page\nShared by all"] * 10
    texts = [*many, *copies, None, "", "Shared by all"]
    sources = [f"s{i}" for i in range(10)] * 2 + [None, "s1", "s2"]
    rows = line_dedup.remove_lines(table(spark, texts, sources=sources, ids=[*range(20), None, 7, 7])).collect()
    assert len(rows) == len(texts)
    found = {(r["row"]["doc_id"], r["row"]["text"]): r for r in rows}
    assert found[(0, many[0])]["text"] == "own line 0\n\nmore of 0" and found[(0, many[0])]["n_removed"] == 1
    assert found[(12, copies[0])]["text"] == copies[0] and found[(12, copies[0])]["n_removed"] == 0
    assert found[(None, None)]["text"] is None and found[(None, None)]["n_lines"] == 0
    assert line_dedup.remove_lines(empty).count() == 0


def test_pipeline_cuts_boilerplate_that_outweighs_own_words(spark):
    notice = "one long notice that every site repeats below its own few words"
    own = [f"own line {i}\n\n {notice} " for i in range(10)]
    texts, sources = [*own, f"{notice}\n \n{notice}"], [f"s{i}" for i in range(11)]
    docs = table(spark, texts, sources=sources)
    found = {r["doc_id"]: r["text"] for r in corpus_pipeline.remove_boilerplate(spark, docs, "").collect()}
    assert found == {i: f"own line {i}\n" for i in range(10)} | {10: texts[10]}
    assert {r["row"]["doc_id"]: r["n_removed"] for r in line_dedup.remove_lines(docs).collect()} == {i: 1 for i in range(10)} | {10: 0}


def test_passages_need_fewer_sites(spark):
    passage, line = " ".join(["word"] * 51), " ".join(["word"] * 50)
    texts = [f"own {i}\n{shared}" for shared in (passage, line) for i in range(3)]
    found = line_dedup.remove_lines(table(spark, texts, sources=["a", "b", None] * 2)).collect()
    assert {r["row"]["doc_id"]: r["n_removed"] for r in found} == {0: 1, 1: 1, 2: 1, 3: 0, 4: 0, 5: 0}
    long = line_dedup.remove_lines(table(spark, [f"own\n{LONG}", f"other\n{LONG}", f"x\n{LONG}"], sources=["a", "b", "c"])).collect()
    assert sorted(r["text"] for r in long) == ["other", "own", "x"]


def test_pipeline_drops_repeated_rows_of_one_id(spark, empty):
    same = "a text of some words that comes in two equal rows"
    docs = table(spark, [same, same, "other words", None, None, same], ids=[4, 4, 4, None, None, 9])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    found = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in kept.collect())
    assert found == [(-1, ""), (-1, ""), (4, same), (4, "other words")]
    assert corpus_pipeline.drop_near_duplicates(spark, empty, "").count() == 0


def test_pipeline_stages_take_odd_rows(spark, odd, sf):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == odd.columns, name
    left = docs.collect()
    assert all(any(c.isalpha() for c in r["text"]) for r in left) and {r["text"] for r in left} >= {"x", LONG}
    assert len(corpus_pipeline.encode(spark, docs, sf).collect()) == len(left)


def test_line_spread_near_the_threshold_is_exact(spark):
    texts = [f"line {k}" for k in (7, 8, 9, 40) for _ in range(k)]
    sources = [f"s{i}" for k in (7, 8, 9, 40) for i in range(k)]
    assert line_dedup.spread_lines(table(spark, texts, sources=sources)).count() == 3


def near_copies(n, words, seed):
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rnd.randint(0, 12)):
            copy[rnd.randrange(words)] = f"x{rnd.randint(0, 10**6)}"
        out.append(" ".join(copy))
    return out


def test_near_duplicates_equal_all_pairs(spark, empty):
    from tests.llm.test_queries import roots_of, sets_of

    texts = [*near_copies(60, 150, 1), *near_copies(40, 90, 2), "short one", "Short ONE", "", None, "  ", *["same text of six plain words"] * 5]
    rows = minhash.link(table(spark, texts), shingle_words=4).collect()
    sets = sets_of(dict(enumerate(texts)), 4)
    roots = roots_of(sets)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows} == {
        d: (len(sets[d]), roots[d], roots[d] == d) for d in sets
    }
    assert minhash.link(empty).count() == 0


def test_near_duplicates_with_repeated_and_null_ids(spark):
    texts = ["a b c d e f g h", "p q r s t u v w", "a b c d e f g h", "p q r s t u v w", "a b c d e f g h", None]
    rows = minhash.link(table(spark, texts, ids=[5, 5, 9, 3, None, None])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in rows) == [
        (-1, -1, True), (-1, -1, True), (3, 3, True), (5, 3, False), (5, 3, False), (9, 3, False),
    ]


def test_components_of_chains_and_rings(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (95, 100), (7, 7), (200, 201)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 1 for i in range(1, 41)} | {90: 90, 95: 90, 100: 90, 200: 200, 201: 200}


def test_quality_rule_edges(spark, odd, empty):
    rows = quality_rules.check(odd).collect()
    assert len(rows) == len(ODD) and all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] < 10)
    long = next(r for r in rows if r["n_words"] == 80_000)
    assert long["n_repeat_words"] == 80_000 and long["base_failed"]
    # A language without reference, and none at all: only the base rules speak.
    texts = ["one two three four five six seven eight nine ten eleven"] * 2
    reference = quality_rules.references(empty)
    judged = quality_rules.judge(table(spark, texts, langs=["xx", None]), reference).collect()
    assert all(r["kept"] and r["word_distance"] is None for r in judged)
    assert quality_rules.check(empty).count() == 0


def test_decontamination_edges(spark, odd, empty):
    items = spark.createDataFrame(
        [(1, "a b c d e f g"), (2, "A-b c"), (None, "x"), (3, None), (4, ""), (5, "x"), (10, "X")], "item_id long, text string"
    )
    rows = decontamination.annotate(odd, items).collect()
    assert len(rows) == len(ODD)
    found = {(r["row"]["doc_id"], r["row"]["text"]): r for r in rows}
    assert found[(4, "x")]["items"] == ["10", "5"] and found[(4, "x")]["contaminated"]
    assert found[(8, ODD[8])]["items"] == ["1", "2"] and found[(8, ODD[8])]["n_hit"] == 7
    assert found[(0, None)]["n_words"] == 0 and not found[(0, None)]["contaminated"]
    assert decontamination.annotate(odd, items.limit(0)).where("contaminated").count() == 0
    assert decontamination.annotate(empty, items).count() == 0
    kept = decontamination.clean(odd, items)
    assert kept.columns == odd.columns and kept.where("doc_id in (4, 8)").count() == 0


def test_items_without_id_give_hits(spark):
    items = spark.createDataFrame([(None, "Passage without id"), (7, "other words")], "item_id long, text string")
    docs = table(spark, ["a passage without id", "other words, passage without id", "nothing of it"])
    found = {r["row"]["doc_id"]: (r["n_hit"], r["items"], r["contaminated"]) for r in decontamination.annotate(docs, items).collect()}
    assert found == {0: (3, [], True), 1: (5, ["7"], True), 2: (0, [], False)}
    assert [r["doc_id"] for r in decontamination.clean(docs, items).collect()] == [2]


def test_classifier_edges(spark, odd, empty):
    labels = spark.createDataFrame([(0, 1), (4, 0), (8, 1), (8, 1), (None, 0), (5, None)], "doc_id long, quality int")
    machine = quality_fm.fit(odd, labels)
    scores = [r[0] for r in odd.select(quality_fm.scorer(odd, machine)(odd["text"], odd["n_chars"])).collect()]
    assert len(scores) == len(ODD) and all(0 <= s <= 1 for s in scores)
    assert quality_fm.fit(empty, labels).bias == 0
    # The linear-time form equals the sum over all pairs.
    x = quality_fm.Sparse(np.array([0, 3]), np.array([1, 5, 9]), np.array([0.5, -1.0, 2.0]))
    v = machine.factors[x.index] * x.value[:, None]
    pairs = sum(v[i] @ v[j] for i in range(3) for j in range(i))
    out, _ = quality_fm.margins(x, machine)
    assert np.isclose(out[0], machine.bias + machine.linear[x.index] @ x.value + pairs)


def test_url_edges(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?q", "http://xexample.com/en/", "ftp://a.net/fr/://b", "http://com", "x://net/es/#/"]
    urls += ["http://a.cheap-pills.example.com#x", "http://cheap-pills.example.org/?a", "http://a.spam-farm.example.org", "http://a.net\n/es/", "http://a.net/es/"]
    frame = spark.createDataFrame([(i % 5 or None, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = url_filter.judge_urls(frame, registry.URL_RULES, registry.BLOCKED_HOSTS).toPandas()
    con = duckdb.connect()
    con.register("given", frame.select("page_id", "url").toPandas())
    con.execute("create view pages as select page_id::bigint as page_id, url from given")
    want = con.execute(registry.ORACLES["op10_url_filter"]).df()
    key = list(got.columns)
    tidy = [d[key].astype(object).where(d[key].notna(), "-").astype(str).sort_values(key).reset_index(drop=True) for d in (got, want)]
    tidy[0]["page_id"] = tidy[0]["page_id"].str.replace(".0", "")
    tidy[1]["page_id"] = tidy[1]["page_id"].str.replace(".0", "")
    assert tidy[0].equals(tidy[1])


def test_digest_collisions_are_told_apart(monkeypatch):
    import xxhash

    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda b: len(b))
    array = url_filter.DigestArray(url_filter.pack(["aa", "bb", "c"]))
    assert array.contains([b"aa", b"bb", b"cc", b"c", b"d"]).tolist() == [True, True, False, True, False]
