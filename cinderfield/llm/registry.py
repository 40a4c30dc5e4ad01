"""Registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderfield.llm import bpe_codec, collocations, decontamination, filter_audit, html_extraction, language_id, line_dedup, minhash, quality_fm, quality_rules, token_counts, url_filter, warc
from cinderfield.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Public vocabulary files; they are read where they lie.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
COUNTED = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.in_remainder("doc_id", 4, 2)
    identify = language_id.identifier(docs, language_id.fit(docs.where(~held_out)))
    found = docs.select("doc_id", held_out.alias("held_out"), identify("text").alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


@register
def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the bytes they decode to, as digests."""
    return bpe_codec.digests(table(spark, sf_dir, "documents"), RANKS)


@register
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    extract = html_extraction.extractor(pages, html_extraction.fit(pages))
    found = pages.select("page_id", "url", extract("html").alias("found"))
    return found.select("page_id", "url", "found.text", F.length("found.text").cast("long").alias("n_chars"))


@register
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the lines that spread over many sources."""
    cut = line_dedup.remove_lines(table(spark, sf_dir, "documents"))
    return cut.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", "text")


@register
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, on 4-word shingles."""
    return minhash.link(table(spark, sf_dir, "documents"), shingle_words=4)


@register
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text, and whether they exceed a context of 512."""
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), COUNTED)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@register
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text, learned from labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = language_id.in_remainder("doc_id", 3, 1)
    score = quality_fm.scorer(docs, quality_fm.fit(docs, labels.where(~held_out)))
    scored = docs.select("doc_id", held_out.alias("held_out"), score(F.col("text"), F.col("n_chars")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


URL_RULES = (
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
)
BLOCKED_HOSTS = ("spam-farm.example.org", "cheap-pills.example.com")


@register
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL; the blocked hosts are an example of a list."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, BLOCKED_HOSTS)


_RULE_ROWS = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)
_HOST_ROWS = ", ".join(f"('{h}')" for h in BLOCKED_HOSTS)
ORACLES["op10_url_filter"] = f"""
with parts as (select page_id, url, row_number() over () as n,
    translate(coalesce(regexp_extract(url, '{url_filter.SPLIT}', 1), ''), '{url_filter.UPPER}', '{url_filter.LOWER}') as host,
    coalesce(regexp_extract(url, '{url_filter.SPLIT}', 2), '') as path from pages),
rules(rule_host, rule_path, rule_verdict) as (values {_RULE_ROWS}),
blocked(name) as (values {_HOST_ROWS}),
fits as (select n, rule_host || rule_path as rule, rule_verdict,
    row_number() over (partition by n order by length(rule_host || rule_path) desc, length(rule_host) desc) as place
  from parts join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select p.page_id, p.host, p.path, f.rule,
  coalesce(f.rule_verdict, case when exists (select 1 from blocked b where p.host = b.name or ends_with(p.host, '.' || b.name))
    then 'block' else 'allow' end) as verdict
from parts p left join fits f on f.n = p.n and f.place = 1"""


@register
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every text."""
    judged = quality_rules.check(table(spark, sf_dir, "documents"))
    return judged.drop("char_distance", "word_distance")


_LIMITS = quality_rules.Limits()
_CLASS_COUNTS = ", ".join(f"length(chars) - length(regexp_replace(chars, '{p}', '', 'g')) as {n}" for n, p in quality_rules.CLASSES.items())
_CLASS_NAMES = [*quality_rules.CLASSES, "rest"]


def _divergence(p: str, q: str) -> str:
    return (
        f"(case when {p} > 0 then {p} * log2({p} / (({p} + {q}) / 2)) / 2 else 0 end"
        f" + case when {q} > 0 then {q} * log2({q} / (({p} + {q}) / 2)) / 2 else 0 end)"
    )


ORACLES["op7_quality_rules"] = f"""
with docs as (select row_number() over () as r, doc_id, lang, coalesce(text, '') as text from documents),
split_docs as (select *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') as words,
  list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines from docs),
base as (select *, len(words) as n_words, array_to_string(words, '') as chars from split_docs),
counted as (select r, doc_id, lang, n_words, length(chars) as word_chars,
  length(chars) - length(regexp_replace(chars, '[#*$%&|<>]', '', 'g')) as n_symbols,
  len(lines) - len(list_distinct(lines)) as n_dup_lines, {_CLASS_COUNTS} from base),
classed as (select *, word_chars - {' - '.join(quality_rules.CLASSES)} as rest from counted),
spots as (select r, lang, unnest(words) as word, unnest(range(len(words))) as i from base),
wins as (select r, i, [word, lead(word, 1) over w, lead(word, 2) over w, lead(word, 3) over w, lead(word, 4) over w] as win
  from spots window w as (partition by r order by i)),
twice as (select r, i from (select r, i, count(*) over (partition by r, win) as n from wins where win[5] is not null) where n > 1),
covered as (select r, count(distinct i + k) as n_repeat_words from twice, range(5) t(k) group by r),
lang_sums as (select lang, sum(n_words) as n_words, sum(word_chars) as word_chars, {', '.join(f'sum({n}) as {n}' for n in _CLASS_NAMES)}
  from classed where lang is not null group by lang),
lang_words as (select lang, word, count(*) as n from spots where lang is not null group by lang, word),
common as (select * from (select *, row_number() over (partition by lang order by n desc, word) as place from lang_words)
  where place <= {quality_rules.COMMON_WORDS}),
ref_words as (select c.lang, c.place, c.word, c.n / s.n_words as q from common c join lang_sums s using (lang)
  union all select s.lang, {quality_rules.COMMON_WORDS + 1}, null, (s.n_words - sum(c.n)) / s.n_words
  from lang_sums s join common c using (lang) group by s.lang, s.n_words),
doc_words as (select s.r, c.place, count(*) as n from spots s join common c on c.lang = s.lang and c.word = s.word group by s.r, c.place),
doc_other as (select c.r, c.n_words - coalesce(sum(d.n), 0) as n from classed c left join doc_words d using (r) group by c.r, c.n_words),
word_terms as (select c.r, w.q as q, coalesce(case when w.place <= {quality_rules.COMMON_WORDS} then d.n else o.n end, 0) / c.n_words as p
  from classed c join ref_words w on w.lang = c.lang join doc_other o on o.r = c.r
  left join doc_words d on d.r = c.r and d.place = w.place where c.n_words > 0),
word_distances as (select r, sqrt(greatest(0, sum({_divergence('p', 'q')}))) as word_distance from word_terms group by r),
char_terms as (select c.r, unnest([{', '.join(f'c.{n} / c.word_chars' for n in _CLASS_NAMES)}]) as p,
  unnest([{', '.join(f's.{n} / s.word_chars' for n in _CLASS_NAMES)}]) as q
  from classed c join lang_sums s on s.lang = c.lang where c.n_words > 0),
char_distances as (select r, sqrt(greatest(0, sum({_divergence('p', 'q')}))) as char_distance from char_terms group by r),
judged as (select c.*, coalesce(v.n_repeat_words, 0) as n_repeat_words,
  c.n_words < 10 or 100 * coalesce(v.n_repeat_words, 0) > 20 * c.n_words as base_failed,
  coalesce(c.n_words >= {_LIMITS.min_words} and (
    char_distance > {_LIMITS.char_base}::double + {_LIMITS.char_slack}::double / sqrt(c.n_words)
    or word_distance > {_LIMITS.word_base}::double + {_LIMITS.word_slack}::double / sqrt(c.n_words)), false) as odd
  from classed c left join covered v using (r) left join char_distances using (r) left join word_distances using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not odd as kept from judged"""


@register
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words and items found in every document."""
    found = decontamination.annotate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def _item_words(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), '{quality_rules.W.UPPER}', '{quality_rules.W.LOWER}')"
    return f"list_filter(string_split_regex({lowered}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"


def contamination_sql(documents: str) -> str:
    """Common table expressions that end in ``found``: hits of every row r of ``documents``."""
    return f"""
docs8 as (select row_number() over () as r, d.*, {_item_words('d.text')} as words8 from {documents} d),
items8 as (select item_id::varchar as item, {_item_words('text')} as words8 from benchmark where item_id is not null),
windows8 as (select distinct item, least(13, len(words8)) as n, array_to_string(words8[i + 1 : i + least(13, len(words8))], ' ') as win
  from (select *, unnest(range(greatest(0, len(words8) - least(13, len(words8)) + 1))) as i from items8 where len(words8) > 0)),
sizes8 as (select distinct n from windows8),
spots8 as (select r, s.n, unnest(range(len(words8) - s.n + 1)) as i, words8 from docs8 join sizes8 s on len(words8) >= s.n),
texts8 as (select r, n, i, array_to_string(words8[i + 1 : i + n], ' ') as win from spots8),
hits8 as (select t.r, t.i, t.n, w.item from texts8 t join windows8 w on w.n = t.n and w.win = t.win),
covered8 as (select r, count(distinct spot) as n_hit from (select r, unnest(range(i, i + n)) as spot from hits8) group by r),
named8 as (select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from hits8 group by r),
found as (select d.*, len(words8) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words8) as contaminated
  from docs8 d left join covered8 using (r) left join named8 using (r))"""


ORACLES["op8_decontamination"] = (
    f"with {contamination_sql('documents')} select doc_id, n_words, n_hit, n_items, items_sha256, contaminated from found"
)


def line_dedup_sql(documents: str) -> str:
    """Common table expressions that end in ``cut``: every row r of ``documents`` with its new text."""
    return f"""
docs4 as (select row_number() over () as r, d.*, string_split(d.text, chr(10)) as lines4 from {documents} d),
lines4 as (select r, coalesce(source, '') as site, unnest(lines4) as line, unnest(range(len(lines4))) as i from docs4),
boiler4 as (select trim(line, ' ') as line from lines4 where regexp_matches(line, '[^\\x20\\x09-\\x0D]')
  group by trim(line, ' ') having count(distinct site) >= case when len({_words("trim(line, ' ')")}) > {line_dedup.LONG_WORDS}
    then {line_dedup.LONG_SITES} else {line_dedup.MIN_SITES} end),
kept4 as (select l.r, count(*) as n_kept, string_agg(line, chr(10) order by i) as text4 from lines4 l
  where not exists (select 1 from boiler4 b where b.line = trim(l.line, ' ')) group by l.r),
sized4 as (select d.*, coalesce(n_kept, 0) as n_kept, coalesce(text4, '') as text4 from docs4 d left join kept4 using (r)),
cut as (select *, coalesce(len(lines4), 0) as n_lines,
  n_kept < len(lines4) and regexp_matches(text4, '[^\\x20\\x09-\\x0D]') as carrier4 from sized4)"""


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


ORACLES["op4_line_dedup"] = f"""with {line_dedup_sql("documents")}
select doc_id, n_lines, case when carrier4 then n_lines - n_kept else 0 end as n_removed, case when carrier4 then text4 else text end as text from cut"""


ORACLES["op5_minhash"] = f"""
with recursive docs5 as (select doc_id,
    {_words(f"translate(coalesce(text, ''), '{quality_rules.W.UPPER}', '{quality_rules.W.LOWER}')")} as words5 from documents),
spots5 as (select doc_id, words5, unnest(range(greatest(1, len(words5) - 3))) as i from docs5 where len(words5) > 0),
shingles5 as (select distinct doc_id, array_to_string(words5[i + 1 : i + 4], ' ') as s from spots5),
sizes5 as (select doc_id, count(*) as n from shingles5 group by doc_id),
common5 as (select a.doc_id as a, b.doc_id as b, count(*) as c from shingles5 a join shingles5 b on a.s = b.s and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id),
links5 as (select a, b from common5 join sizes5 x on x.doc_id = a join sizes5 y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
reach5(a, b) as (select doc_id, doc_id from docs5 union select r.a, l.b from reach5 r join links5 l on l.a = r.b),
roots5 as (select a as doc_id, min(b) as component_id from reach5 group by a)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from docs5 d join roots5 r using (doc_id) left join sizes5 s using (doc_id)"""


@register
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents kept and removed by five filters in each of their orders, per source."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_BITS = " ".join(f"when '{name}' then {1 << i}" for i, name in enumerate(filter_audit.FILTERS))
ORACLES["op12_filter_audit"] = f"""
with docs as (select doc_id, coalesce(text, '') as text, coalesce(source, '') as part, {_words("text")} as words from documents),
firsts as (select text, min(doc_id) as first from docs group by text),
marks as (select doc_id, coalesce(max((quality = 1)::int), 0) as good, coalesce(max((toxic = 1)::int), 0) as toxic from labels group by doc_id),
masks as (select part, (len(words) < 50)::int + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::int
    + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]+', '', 'g'))) > 5 * length(text))::int
    + 8 * regexp_matches(text, '[#$%&*|]')::int + 16 * (first is not null and not coalesce(doc_id <= first, false))::int as m,
    coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
  from docs left join firsts using (text) left join marks using (doc_id)),
counted as (select part, m, count(*) as n, sum(good) as good, sum(toxic) as toxic from masks group by part, m),
names(x) as (values {', '.join(f"('{name}')" for name in filter_audit.FILTERS)}),
orders as (select a.x || b.x || c.x || d.x || e.x as filter_order from names a, names b, names c, names d, names e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
bits as (select filter_order, step, case filter_order[step] {_BITS} end as own from orders, range(1, 6) s(step)),
steps as (select *, coalesce(sum(own) over (partition by filter_order order by step rows between unbounded preceding and 1 preceding), 0)::int as before from bits),
found as (select part, filter_order, step, own,
    coalesce(sum(n) filter (m & (before | own) = 0), 0)::bigint as kept, coalesce(sum(n) filter (m & before = 0 and m & own <> 0), 0)::bigint as removed,
    coalesce(sum(n) filter (m & before <> 0 and m & own <> 0), 0)::bigint as redundant, coalesce(sum(n) filter (m = own), 0)::bigint as unique_fails,
    coalesce(sum(good) filter (m & before = 0 and m & own <> 0), 0)::bigint as good_lost,
    coalesce(sum(toxic) filter (m & before = 0 and m & own <> 0), 0)::bigint as toxic_lost
  from counted, steps group by part, filter_order, step, own)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, own))::bigint as shapley from found"""


@register
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of each language."""
    return collocations.top_phrases(table(spark, sf_dir, "documents"))


_LENGTHS = range(2, collocations.MOST_WORDS + 1)
_INNER = " union all ".join(
    f"select lang, array_to_string(list_slice(w, {start}, {start + size - 1}), ' ') as phrase, a as longer from candidates where k = {words}"
    for words in _LENGTHS
    for start, size in collocations._inner(words)
)
ORACLES["op13_collocations"] = f"""
with pieces as (select row_number() over () as p, * from (select coalesce(lang, 'und') as lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{quality_rules.W.UPPER}', '{quality_rules.W.LOWER}'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents)),
spots as (select lang, p, unnest(w) as word, unnest(range(len(w))) as i
  from (select lang, p, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') as w from pieces)),
wins as (select lang, word, {', '.join(f'lead(word, {k}) over t as w{k}' for k in range(1, collocations.MOST_WORDS))} from spots window t as (partition by p order by i)),
grams as (select lang, 1 as k, [word] as w from wins
  {' '.join(f"union all select lang, {k}, [word, {', '.join(f'w{i}' for i in range(1, k))}] from wins where w{k - 1} is not null" for k in _LENGTHS)}),
f as (select lang, k, w, array_to_string(w, ' ') as phrase, count(*) as a from grams group by lang, k, w),
sizes as (select lang, sum(a)::bigint as n from f where k = 1 group by lang),
candidates as (select * from f where k > 1 and a >= 100),
cuts as (select c.*, unnest(range(1, k)) as cut from candidates c),
rated as (select c.lang, c.phrase, c.a, c.cut, x.a as l, y.a as r, n, (1000::hugeint * c.a * n) // (x.a::hugeint * y.a) as score
  from cuts c join f x on x.lang = c.lang and x.k = c.cut and x.w = list_slice(c.w, 1, c.cut)
  join f y on y.lang = c.lang and y.k = c.k - c.cut and y.w = list_slice(c.w, c.cut + 1, c.k) join sizes s on s.lang = c.lang),
worst as (select * from (select *, row_number() over (partition by lang, phrase order by score, cut) as place from rated) where place = 1),
inside as (select lang, phrase, max(longer) as longer from ({_INNER}) group by lang, phrase),
kept as (select w.* from worst w left join inside i using (lang, phrase) where longer is null or 100 * longer < 100 * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked where rank <= 2000"""


@register
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back: its payload's size and digest, and its record."""
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "archive")
    warc.write_archive(warc.page_records(pages), path)
    id_type = pages.schema["page_id"].dataType
    found = warc.page_facts(spark, path)
    return found.select(
        F.col("page_id").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(id_type).alias("refers_to")
    )


ORACLES["op11_warc"] = f"""
with payloads as (select page_id, strlen(coalesce(html, '')) as size, sha256(coalesce(html, '')) as digest from pages),
firsts as (select digest, min(page_id) as first from payloads where size >= {warc.LEAST_REVISIT} group by digest)
select page_id, size as payload_bytes, digest as payload_digest, case when first <> page_id then 'revisit' else 'response' end as record_type,
  case when first <> page_id then first end as refers_to from payloads left join firsts using (digest)"""
