"""Filter audit, phrase mining and archives: brute force, round trips and odd rows."""

import collections
import hashlib
import itertools
import random
import re
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cinderfield.llm import collocations, filter_audit, warc
from cinderfield.scratch import scratch_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Names that the operators use themselves, as further columns of the input.
CLASH = "doc_id long, text string, lang string, source string, fails int, first int, digest string, shard int, n long, words int, phrase string, reached int"


def documents(spark, rows):
    """Rows (id, text, lang, source) with clashing columns behind."""
    return spark.createDataFrame([(*r, 7, 7, "x", 7, 7, 7, "x", 7) for r in rows], CLASH)


def failing(rows):
    """Mask per row by the plain reading of the five rules."""
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, text, _, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        rules = (
            len(words) < 50,
            100 * len(set(words)) < 65 * len(words),
            100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            any(c in "#$%&*|" for c in text),
            text in first and (i is None or i > first[text]),
        )
        yield i, source or "", sum(1 << k for k, r in enumerate(rules) if r)


def test_audit_equals_applying_filters_one_by_one(spark):
    rnd = random.Random(5)
    many = [f"w{i}" for i in range(70)]
    texts = [None, "", "# short", "SHOUT " * 60, "same " * 80, " ".join(many), " ".join(many) + " 100%", " ".join(many).upper(), "long " * 30_000]
    rows = [(rnd.choice([*range(60), None]), rnd.choice(texts), "en", rnd.choice(["a", "b", "", None])) for _ in range(300)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 60, 2)] + [(4, 1, 1), (None, 1, 1)]
    found = filter_audit.audit(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    good, toxic = ({i for i, *marks in labels if i is not None and marks[k] == 1} for k in (0, 1))
    masks = list(failing(rows))
    parts = {p for _, p, _ in masks}
    assert len(found) == 600 * len(parts) and parts == {"a", "b", ""}
    want, removed = {}, collections.Counter()
    for part in parts:
        for order in itertools.permutations("ABCDE"):
            left, gone = [(i, m) for i, p, m in masks if p == part], []
            for step, name in enumerate(order, 1):
                bit = 1 << "ABCDE".index(name)
                out = [x for x in left if x[1] & bit]
                left = [x for x in left if not x[1] & bit]
                removed[part, name] += len(out)
                want[part, "".join(order), step] = (
                    len(left), len(out), sum(bool(m & bit) for _, m in gone), sum(p == part and m == bit for _, p, m in masks),
                    sum(i in good for i, _ in out), sum(i in toxic for i, _ in out),
                )
                gone += out
    for r in found:
        got = (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"])
        assert got == want[r["part"], r["filter_order"], r["step"]], r
        assert r["shapley"] == removed[r["part"], r["filter_order"][r["step"] - 1]]


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(documents(spark, []), labels).count() == 0
    assert filter_audit.audit(documents(spark, [(1, None, None, None)]), labels).where("kept > 0").count() == 120 * 5 - 5 * 120 + 4 * 24 + 3 * 24 + 2 * 24 + 24


def test_carry_save_counts_equal_plain_counts():
    rnd = np.random.default_rng(1)
    owner = np.sort(rnd.integers(0, 40, 5000))
    owner = owner[owner != 7]
    words = rnd.integers(0, 1 << 32, len(owner), dtype=np.uint64).astype(np.uint32)
    plain = np.zeros((40, 32), int)
    np.add.at(plain, owner, (words[:, None] >> np.arange(32, dtype=np.uint32)) & 1)
    assert (filter_audit.positional_counts(owner, words, 40) == plain).all()
    assert filter_audit.positional_counts(owner[:0], words[:0], 2).tolist() == [[0] * 32] * 2


def plain_counts(rows):
    counts, totals = collections.Counter(), collections.Counter()
    for _, text, lang, _ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang or "und", tuple(words[i : i + k])] += 1
    return counts, totals


def plain_top(rows, threshold, percent, top):
    f, totals = plain_counts(rows)
    frequent = {p: a for p, a in f.items() if a >= threshold and len(p[1]) > 1}
    out = collections.defaultdict(list)
    for (lang, words), a in frequent.items():
        n = totals[lang]
        score, cut = min((1000 * a * n // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words)))
        inside = any(
            100 * b >= percent * a and len(other) > len(words) and any(other[i : i + len(words)] == words for i in range(len(other)))
            for (where, other), b in frequent.items() if where == lang
        )
        if not inside:
            out[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:cut]], f[lang, words[cut:]], n))
    return {
        (lang, rank, p.decode(), -a, l, r, n, -score)
        for lang, found in out.items()
        for rank, (score, a, p, l, r, n) in enumerate(sorted(found)[:top], 1)
    }


@pytest.fixture(scope="module")
def prose():
    rnd = random.Random(9)
    vocabulary = [*"abcdefghij", "Ünï", "漢字", "İx", "New", "York"]
    rows = []
    for i in range(400):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 30))]
        words = [w + rnd.choice(["", "", "", ",", ".", "\n", "!\t", "\x85", "\r\n"]) for w in words]
        fixed = "one two three four five six" if rnd.random() < 0.2 else "New York"
        rows.append((i, rnd.choice(["", " ", ". "]) + rnd.choice([" ", "\t", "  "]).join(words) + " " + fixed, rnd.choice(["en", "de", None]), "s"))
    return [*rows, (None, None, "en", None), (3, "", None, None), (4, rows[5][1], "en", None), (4, rows[5][1], "en", None), (9, "ab " * 20_000, "xx", None)]


@pytest.mark.parametrize(("threshold", "percent", "top", "chunk"), [(8, 100, 2000, 1 << 20), (3, 60, 15, 300), (40, 100, 5, 50)])
def test_phrases_equal_plain_counting(spark, prose, threshold, percent, top, chunk):
    counts = collocations.count_phrases(documents(spark, prose), threshold, chunk_bytes=chunk)
    f, totals = plain_counts(prose)
    assert {(r["lang"], tuple(r["phrase"].split(" "))): r["n"] for r in counts.phrases.collect()} == {p: a for p, a in f.items() if a >= threshold}
    assert {r["lang"]: r["n"] for r in counts.totals.collect()} == {lang: n for lang, n in totals.items() if n}
    found = collocations.top_phrases(documents(spark, prose), threshold, percent, top)
    assert {tuple(r) for r in found.collect()} == plain_top(prose, threshold, percent, top)


def test_phrases_of_nothing(spark):
    assert collocations.top_phrases(documents(spark, [])).count() == 0
    assert collocations.top_phrases(documents(spark, [(1, None, None, None), (2, " .,", None, None)])).count() == 0


def test_full_mark_cells_change_no_count():
    """With every cell marked at the first scan, phrases start early and are counted for one cycle all the same."""
    names, numbers = collocations.number_words(b"a b a b a. b a", np.array([0, 14]))
    marks, cells = np.zeros(1 << collocations.MARK_BITS, np.uint8), np.full((1 << collocations.CELL_BITS) // 8, 255, np.uint8)
    seen = collections.defaultdict(list)
    for scan in range(8):
        for _, phrases, _, _, n in collocations.count_chunk("en", names, numbers, scan, marks, cells):
            for p, c in zip(phrases.to_pylist(), n.tolist(), strict=True):
                seen[p].append((scan, c))
    assert seen["a"] == [(s, 4) for s in range(4)] and seen["a b"] == [(s, 2) for s in range(1, 5)] and seen["b a"] == [(s, 3) for s in range(1, 5)]
    assert seen["a b a"] == [(s, 2) for s in range(1, 5)] and "a b a b a b" not in seen


def test_marks_of_other_phrases_do_not_start_a_phrase_before_it_is_followed():
    """The cells of "a b" and "b c" are marked by others two scans before those of the words: "a b c" still gets a whole cycle."""
    names, numbers = collocations.number_words(b"a b c", np.array([0, 5]))
    cells = np.full((1 << collocations.CELL_BITS) // 8, 255, np.uint8)
    one, two, three = names.to_pylist()
    hashes = collocations.word_hashes([one, two, three])
    words = collocations._first_keys("en", hashes)
    pairs = collocations._longer(words[:2], hashes[1:])
    seen = collections.defaultdict(list)
    marks = np.full(1 << collocations.MARK_BITS, collocations.NEVER, np.uint8)
    for scan in range(10):
        for _, phrases, _, _, _ in collocations.count_chunk("en", names, numbers, scan, marks, cells):
            for p in phrases.to_pylist():
                seen[p].append(scan)
        for keys, marked_in in ((pairs, 0), (words, 2)):
            if scan == marked_in:
                for cell in collocations.mark_cells(keys):
                    marks[cell] = scan
    assert seen["a b"] == seen["a b c"] == [3, 4, 5, 6]


@pytest.mark.parametrize(("least", "most"), [(1 << 17, 1 << 19), (2, 1 << 19), (2, 3)])
def test_a_task_of_a_scan_gives_one_row_per_phrase_of_all_its_chunks(monkeypatch, least, most):
    monkeypatch.setattr(collocations, "AT_LEAST", least)
    monkeypatch.setattr(collocations, "MOST_HELD", most)
    chunks = [(lang, *collocations.number_words(text, np.array([0, len(text)]))) for lang, text in [("en", b"a b a"), ("en", b"b c"), ("de", b"a a"), ("en", b"a c c")]]
    batches = [pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([names.to_pylist()]), pa.array([numbers.tolist()], pa.list_(pa.int32()))], names=["lang", "names", "numbers"]) for lang, names, numbers in chunks]
    marks, cells = np.full(1 << collocations.MARK_BITS, collocations.NEVER, np.uint8), np.full((1 << collocations.CELL_BITS) // 8, 255, np.uint8)
    shared = types.SimpleNamespace(value=(marks.tobytes(), cells.tobytes()))
    rows = [r for b in collocations._scanned(0, shared)(iter(batches)) for r in b.to_pylist()]
    n = collections.Counter()
    for r in rows:
        n[r["lang"], r["phrase"]] += r["n"]
    assert n == {("en", ""): 8, ("en", "a"): 3, ("en", "b"): 2, ("en", "c"): 3, ("de", ""): 2, ("de", "a"): 2}
    assert most == 3 or len(rows) == len(n)


def test_cells_hold_all_lengths_and_stop_at_the_cap():
    names, numbers = collocations.number_words(b"x x " * 50_000 + b". y z", np.array([0, 200_005]))
    hashes = np.append(np.uint64(0), collocations.word_hashes(names.to_pylist()))
    cells = np.zeros(1 << collocations.CELL_BITS, np.uint16)
    collocations._add_to_cells(cells, "en", hashes, numbers, 30_000)
    assert sorted(cells[cells > 0].tolist()) == [1, 1, 1] + [30_000] * 5
    collocations._add_to_cells(cells, "en", hashes, numbers, 30_000)
    assert sorted(cells[cells > 0].tolist()) == [2, 2, 2] + [30_000] * 5


PAGES = [
    (3, "http://a/\r\nWARC-Type: x", "p" * 100, "u"), (1, "http://b", "p" * 100, "u"), (2, None, "p" * 99, "u"), (5, "", "p" * 99, "u"),
    (7, "http://c/é", None, "u"), (8, "x", "", "u"), (9, "y", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9, "u"), (1, "http://b", "p" * 100, "u"),
    (None, "z", "p" * 100, "u"), (None, "z", "q" * 200, "u"), (11, "big", "<p>é漢😀</p>" * 200_000, "u"), (12, "big", "<p>é漢😀</p>" * 200_000, "u"),
]


def page_table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "page_id long, url string, html string, id string, payload string, first int, digest string")


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archive_round_trip(spark, compression):
    path = scratch_path(spark, "warc")
    warc.write_archive(warc.page_records(page_table(spark, PAGES)), path, compression)
    archive = warc.read_archive(spark, path)
    rows = archive.collect()
    assert len(rows) == len(PAGES) and all(len(r["payload"]) == 0 for r in rows if r["type"] == "revisit")
    responses = sorted((r["record_id"] or "", r["payload"].decode()) for r in rows if r["type"] == "response")
    assert responses == sorted((f"urn:page:{i}" if i else "", h or "") for i, _, h, _ in PAGES if (i, h) not in ((3, "p" * 100), (12, PAGES[-1][2]), (None, "p" * 100)))
    assert {r["target_uri"] for r in rows if r["record_id"] == "urn:page:3"} == {"http://a/%0D%0AWARC-Type: x"}
    facts = warc.page_facts(spark, path).collect()
    got = sorted((r["page_id"] or "-", r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in facts)
    first = {"p" * 100: 1, PAGES[-1][2]: 11}
    want = []
    for i, _, h, _ in PAGES:
        data = (h or "").encode()
        to = first.get(h) if first.get(h) != i else None
        want.append((str(i) if i else "-", len(data), hashlib.sha256(data).hexdigest(), "revisit" if to else "response", str(to) if to else None))
    assert got == sorted(want, key=lambda x: x[:4])


def test_archive_of_nothing(spark):
    path = scratch_path(spark, "warc")
    warc.write_archive(warc.page_records(page_table(spark, [])), path)
    assert warc.page_facts(spark, path).count() == 0


def test_filters_reach_the_reader(spark, tmp_path):
    """Records that a pushed filter rejects are not even inflated: their payload may be damaged."""
    head = {"type": "response", "record_id": "urn:1", "content_type": "text/plain"}
    good = warc.gzip_member(warc.record_bytes(head, b"kept"))
    bad = bytearray(warc.gzip_member(warc.record_bytes(head | {"type": "metadata", "target_uri": "http://x"}, bytes(np.random.default_rng(0).integers(0, 256, 100_000, np.uint8)))))
    bad[60_000:61_000] = b"\xff" * 1000
    foreign = zlib.compressobj(9, zlib.DEFLATED, 31)
    foreign = foreign.compress(warc.record_bytes(head | {"type": "request", "record_id": "urn:2"}, b"x" * 99_999)) + foreign.flush()
    (tmp_path / "a.warc.gz").write_bytes(good + bytes(bad) + foreign + good)
    (tmp_path / "b.warc").write_bytes(warc.record_bytes(head | {"type": "request"}, b"y" * 10) + warc.record_bytes(head | {"record_id": "urn:3"}, b"plain"))
    (tmp_path / "_ignored.txt").write_text("no archive")
    archive = warc.read_archive(spark, str(tmp_path))
    found = archive.where("type = 'response' and record_id like 'urn:%'").select("record_id", "payload", "content_length").collect()
    assert sorted((r[0], bytes(r[1]), r[2]) for r in found) == [("urn:1", b"kept", 4), ("urn:1", b"kept", 4), ("urn:3", b"plain", 5)]
    assert archive.where("type in ('request')").select("record_id").where("length(payload) > 11").count() == 1
    with pytest.raises(Exception, match="invalid|incorrect|Error"):
        archive.collect()
    plan = archive.where("type = 'response'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "type" in plan.split("PushedFilters")[1]


def test_damaged_archives_fail(spark, tmp_path):
    (tmp_path / "c.warc").write_bytes(b"no record at all")
    with pytest.raises(Exception, match="no record at byte 0"):
        warc.read_archive(spark, str(tmp_path)).count()
    with pytest.raises(Exception, match="No such|not found|FileNotFound"):
        warc.read_archive(spark, str(tmp_path / "missing")).count()
