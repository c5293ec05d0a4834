"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.llm import decontaminate, filter_audit, license_scan, minhash, nbest, phrases, pii, quality, simhash, suffix_dedup, token_counts, toxicity, url_rules


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def toxicity_model(spark: SparkSession, sf: str) -> toxicity.Model:
    """Fitted on the labelled documents that are not held out."""
    labels = read(spark, sf, "labels").filter(toxicity.fold() != 0)
    return toxicity.fit(read(spark, sf, "documents"), labels)


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    scored = toxicity.toxicity(read(spark, sf, "documents"), toxicity_model(spark, sf))
    return scored.select(
        "doc_id", F.coalesce(toxicity.fold() == 0, F.lit(False)).alias("held_out"), "score", "predicted", "sentences"
    )


def op2_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = suffix_dedup.repeated(read(spark, sf, "documents"), with_text=False).drop("kept_text")
    return found.withColumn("has_repeats", F.col("n_removed") > 0)


def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op4_license_scans(spark: SparkSession, sf: str) -> DataFrame:
    found = license_scan.license_scan(read(spark, sf, "documents"))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(read(spark, sf, "documents"), path)


def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality(read(spark, sf, "documents"))


URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op7_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    return url_rules.judge(read(spark, sf, "pages"), url_rules.rule_table(spark, URL_RULES))


def op8_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    encode = nbest.encoder(spark, path, with_ids=True)
    return read(spark, sf, "documents").select("doc_id", encode("text").alias("r")).select("doc_id", "r.*")


def op9_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf, "documents"))


def op10_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.found_spans(read(spark, sf, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        F.size(F.array_remove(F.transform(kinds, lambda k: k == kind), False)).cast("bigint").alias(f"n_{kind}")
        for kind in pii.KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"),
        pii.as_text(F.col("spans")).alias("spans"),
    )


def op11_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_copies(read(spark, sf, "documents"))
    hexed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf, "documents"), read(spark, sf, "labels"))


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(read(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_toxicity, op2_suffix_dedup, op3_decontamination, op4_license_scans, op5_token_counts, op6_quality_rules,
        op7_url_filters, op8_sentencepiece, op9_minhash, op10_pii,
        op11_simhash, op12_filter_audit, op13_collocations,
    )
}

_URL_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

ORACLES: dict[str, str] = {
    "op7_url_filters": rf"""
with rules(rhost, rpath, rverdict) as (values {_URL_RULES_SQL}),
rest as (
    select row_number() over () as r, page_id,
           case when contains(url, '://') then substr(url, position('://' in url) + 3) else '' end as t
    from pages
),
parts as (
    select r, page_id, translate(regexp_extract(t, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(t, '^[^/?#]*([^?#]*)', 1) as path
    from rest
),
fit as (
    select r, rhost || rpath as rule, rverdict from parts join rules
      on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
    qualify row_number() over (partition by r order by length(rhost || rpath) desc, length(rhost) desc) = 1
)
select page_id, host, path, rule, coalesce(rverdict, 'allow') as verdict
from parts left join fit using (r)
""",
    "op3_decontamination": r"""
with items as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
),
windows as (
    select distinct item_id, least(len(w), 10) as size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as phrase
    from (select *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0)
),
texts as (
    select row_number() over () as t, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
),
words as (select t, unnest(w) as word, generate_subscripts(w, 1) as i from texts),
tens as (select t, i, list(word) over (partition by t order by i rows between current row and 9 following) as w from words),
hits as (
    select t, i, size, item_id
    from (select t, i, size, array_to_string(w[1 : size], ' ') as phrase from tens, (select distinct size from windows) where size <= len(w))
    join windows using (size, phrase)
),
hit as (select t, count(distinct place) as n_hit from (select t, unnest(range(i, i + size)) as place from hits) group by t),
found as (select t, list_sort(list(distinct item_id::varchar)) as ids from hits group by t)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(len(ids), 0)::bigint as n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from texts left join hit using (t) left join found using (t)
""",
    "op9_minhash": r"""
with recursive texts as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
),
words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i, len(w) as n from texts),
fives as (
    select doc_id, i, n, list(word) over (partition by doc_id order by i rows between current row and 4 following) as w from words
),
shingles as (
    select distinct doc_id, array_to_string(w, ' ') as s from fives where len(w) = 5 or (n < 5 and i = 1)
),
sizes as (select doc_id, count(*)::bigint as n from shingles group by doc_id),
shared as (
    select x.doc_id as a, y.doc_id as b, count(*) as c
    from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id group by all
),
links as (
    select a, b from shared join sizes p on p.doc_id = a join sizes q on q.doc_id = b
    where 100 * c >= 75 * (p.n + q.n - c)
),
reach(doc_id, other) as (
    select doc_id, doc_id from documents union select reach.doc_id, links.b from reach join links on links.a = reach.other
)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
from (select doc_id, min(other) as component_id from reach group by doc_id) left join sizes using (doc_id)
""",
    "op12_filter_audit": r"""
with recursive letters(letter, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders(filter_order) as (
    select '' union all
    select filter_order || letter from orders join letters on not contains(filter_order, letter)
),
applied as (
    select filter_order, k as step, l.letter, l.bit,
           coalesce((select sum(b.bit) from letters b where contains(left(filter_order, k - 1), b.letter)), 0)::int as before
    from orders, range(1, 6) steps(k), letters l
    where length(filter_order) = 5 and l.letter = filter_order[k]
),
texts as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
    from documents
),
masks as (
    select part,
           (len(w) < 100)::int + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::int
           + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::int
           + 8 * regexp_matches(t, '[#$%&*|]')::int
           + 16 * (doc_id > min(doc_id) over (partition by t))::int as mask,
           coalesce(quality = 1, false)::int as good, coalesce(toxic = 1, false)::int as toxic
    from texts left join labels using (doc_id)
),
cells as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from masks group by all),
steps as (
    select part, filter_order, step, letter,
           sum(n) filter (mask & (before | bit) = 0) as kept,
           sum(n) filter (mask & bit <> 0 and mask & before = 0) as removed,
           sum(n) filter (mask & bit <> 0 and mask & before <> 0) as redundant,
           sum(n) filter (mask = bit) as unique_fails,
           sum(good) filter (mask & bit <> 0 and mask & before = 0) as good_lost,
           sum(toxic) filter (mask & bit <> 0 and mask & before = 0) as toxic_lost
    from cells, applied group by all
)
select part, filter_order, step::int as step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
       coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
       coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
       coalesce(sum(removed) over (partition by part, letter), 0)::bigint as shapley
from steps
""",
    "op13_collocations": r"""
with texts as (
    select row_number() over () as t, coalesce(lang, 'und') as lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
),
pieces as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from texts),
words as (select lang, w, unnest(range(1, len(w) + 1)) as i from pieces where len(w) > 0),
phrases as (
    select lang, array_to_string(w[i : i + size - 1], ' ') as phrase, size, count(*) as f
    from words, range(1, 5) sizes(size) where i + size - 1 <= len(w) group by all
),
candidates as (select lang, phrase, f as a, size, string_split(phrase, ' ') as w from phrases where size > 1 and f >= 30),
cuts as (
    select c.lang, c.phrase, c.a, k, l.f as l, r.f as r,
           ((2000000::hugeint * c.a) // (l.f + r.f))::bigint as score
    from (select *, unnest(range(1, size)) as k from candidates) c
    join phrases l on l.lang = c.lang and l.phrase = array_to_string(c.w[1 : k], ' ')
    join phrases r on r.lang = c.lang and r.phrase = array_to_string(c.w[k + 1 :], ' ')
    qualify row_number() over (partition by c.lang, c.phrase order by score, k) = 1
),
held as (
    select lang, array_to_string(w[i : i + m - 1], ' ') as phrase, max(a) as longer
    from (select *, unnest(range(1, size)) as i from candidates where size > 2), range(2, 4) inner_sizes(m)
    where m < size and i + m - 1 <= size group by all
),
totals as (select lang, sum(f)::bigint as n from phrases where size = 1 group by lang)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from cuts left join held using (lang, phrase) join totals using (lang)
where longer is null or 100::hugeint * longer < 80::hugeint * a
qualify rank <= 2000
""",
}
