"""The query of each operator over its whole tables, and SQL that gives the same rows."""

from __future__ import annotations

from gablestone.llm import contamination, divergence, katz, lang_id, licenses, near_dups, packing, quality_rules, resampling, sentencepieces, token_counts, token_frames, url_rules
from gablestone.llm._base import table

#: (verdict, host, path)
URL_RULES = [
    ("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"),
]


TOKENIZER = "byte_bpe_50k.json"


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_frames(spark, sf_dir):
    return token_frames.op1(table(spark, sf_dir, "documents"), tokenizer_file())


def op2_contamination(spark, sf_dir):
    return contamination.op2(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file())


def op3_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer=tokenizer_file())


def op9_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_katz(spark, sf_dir):
    return katz.op4(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark, sf_dir):
    return quality_rules.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def quality_rules_loose(spark, sf_dir):
    """The same at a limit of one in ten, which small tables can certify too."""
    return quality_rules.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), limit=0.1)


def op6_near_dups(spark, sf_dir):
    return near_dups.groups(table(spark, sf_dir, "documents"), width=2)


def op10_lang_id(spark, sf_dir):
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op7_url_filter(spark, sf_dir):
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rule_table(spark, URL_RULES))


def op11_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_sentencepiece(spark, sf_dir):
    return sentencepieces.round_trip(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op13_importance_resampling(spark, sf_dir):
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP5_SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as t, coalesce(lang, '') as stratum,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as l,
    row_number() over () as rid
  from documents),
win as (select rid, i, array_to_string(w[i:i + 7], ' ') as k from (select rid, w, unnest(range(1, len(w) - 6)) as i from d where len(w) >= 8)),
dup as (select rid, i from (select rid, i, count(*) over (partition by rid, k) as c from win) where c > 1),
rep as (select rid, sum(least(8, coalesce(nxt - i, 8))) as n from (select rid, i, lead(i) over (partition by rid order by i) as nxt from dup) group by rid),
f as (
  select d.rid, doc_id, stratum, cast(len(w) as bigint) as n_words,
    cast(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, cast(len(l) as bigint) as n_lines,
    cast(coalesce(rep.n, 0) as bigint) as n_repeat_words,
    cast(len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) as bigint) as n_adjacent
  from d left join rep on d.rid = rep.rid),
b as (select *, (n_words < 20 or 100 * n_repeat_words > 30 * n_words) as base_failed,
    n_symbols * 1000 // greatest(word_chars, 1) as symbols, n_repeat_words * 1000 // greatest(n_words, 1) as repeats, n_adjacent * 1000 // greatest(n_words, 1) as adjacent, n_dup_lines * 1000 // greatest(n_lines, 1) as lines
  from f),
steps(step, level) as (values (0, 900), (1, 700), (2, 500), (3, 300), (4, 200), (5, 100), (6, 50), (7, 30), (8, 20), (9, 10)),
hit as (select rid, min(step) as step from b join steps on symbols >= level or adjacent >= level or repeats >= least(900, 3 * level) or lines >= least(900, 3 * level) group by rid),
good as (select b.stratum, b.doc_id, min(coalesce(hit.step, 10)) as first from b left join hit on b.rid = hit.rid
  join (select doc_id from labels group by doc_id having min(quality) = 1) l on l.doc_id = b.doc_id where not base_failed group by all),
tried as (select stratum, steps.step, count(*) as n, count(*) filter (where first <= steps.step) as k from good cross join steps group by all),
p as (select *, case when k >= n * LIMIT::double then 1 else list_sum(list_transform(range(0, k + 1), lambda i:
    exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(LIMIT::double) + (n - i) * ln(1 - LIMIT::double)))) end as tail,
    (select count(distinct stratum) from good) as strata from tried),
reach as (select stratum, max(step) as step from p where tail <= 0.05::double / strata group by stratum)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (not base_failed and coalesce(hit.step > reach.step, true)) as kept
from b left join hit on b.rid = hit.rid left join reach on reach.stratum = b.stratum
"""

OP7_SQL = """
with p as (select page_id, row_number() over () as rid, case when strpos(coalesce(url, ''), '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
q as (select page_id, rid, regexp_extract(rest, '^[^/?#]*') as raw, rest from p),
h as (select page_id, rid, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from q),
rules(verdict, rhost, rpath) as (values ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('block', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
m as (select rid, rhost || rpath as rule, verdict, row_number() over (partition by rid order by length(rhost || rpath) desc, rhost || rpath) as k
  from h join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath))
select page_id, host, path, m.rule, coalesce(m.verdict, 'allow') as verdict from h left join m on h.rid = m.rid and m.k = 1
"""

OP11_SQL = r"""
with d as (select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as t from documents),
w as (select rid, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term, count(*) as n from w group by all having count(distinct rid) >= 30),
v as (select lang, count(*) as v, sum(n) as n from kept group by lang),
c as (select lang, source, term, count(*) as n from w semi join kept using (lang, term) group by all),
grp as (select distinct lang, source from d),
tot as (select g.lang, g.source, coalesce(sum(c.n), 0) as n from grp g left join c using (lang, source) group by all),
p as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (g.n + 5 * v.v)::hugeint as p, 1 + (1000000000::hugeint * (k.n + 5)) // (v.n + 5 * v.v)::hugeint as q
  from tot g join kept k using (lang) join v using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
dist as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as f from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pair as (select a.lang, a.source, b.source as item, cast(coalesce(f, 0) as bigint) as value from grp a join grp b on a.lang = b.lang and a.source <> b.source
  left join dist on dist.lang = a.lang and dist.source = a.source and dist.item = b.source),
ranked as (select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, encode(item)) as rank from pair),
term as (select lang, source, 'term' as part, term as item, cast(p - q as bigint) as value, row_number() over (partition by lang, source order by p - q desc, encode(term)) as rank from p where n > 0 and p > q)
select lang, source, part, item, value, cast(rank as int) as rank from ranked
union all select lang, source, part, item, value, cast(rank as int) from term where rank <= 50
"""

OP13_SQL = r"""
with recursive step(b, k, c) as (select b, 0, b from range(256) t(b) union all select b, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from step where k < 8),
crc as (select list(c order by b) as crc from step where k = 8),
d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t, true as own from documents union all select -row_number() over (), null, coalesce(text, ''), false from benchmark),
w as (select rid, own, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from d),
hex as (select word, hex(encode(word)) as h from (select distinct word from w)),
bucket as (select word, xor(list_reduce(list_transform(range(0, length(h) // 2), lambda i: cast('0x' || substr(h, 2 * i + 1, 2) as bigint)),
    lambda c, x: xor(crc[(xor(c, x) & 255) + 1], c >> 8), 4294967295::bigint), 4294967295) % 10000 as bucket from hex, crc),
n as (select bucket, count(*) filter (where own) as s, count(*) filter (where not own) as t from w join bucket using (word) group by bucket),
total as (select sum(s) as s, sum(t) as t from n),
gain as (select bucket, cast(floor(1000 * ln(cast(n.t + 1 as double) * cast(total.s + 10000 as double) / (cast(n.s + 1 as double) * cast(total.t + 10000 as double)))) as bigint) as g from n, total),
f as (select rid, count(*) as n, sum(g) as g from w join bucket using (word) join gain using (bucket) where own group by rid),
doc as (select d.rid, doc_id, cast(coalesce(f.n, 0) as bigint) as n_features, cast(case when f.n is null then 0 else (f.g - (f.g % f.n + f.n) % f.n) // f.n end as bigint) as weight,
    cast('0x' || substr(sha256('2024:' || doc_id), 1, 8) as bigint) as h from d left join f on f.rid = d.rid where own),
s as (select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296))) as bigint) as score from doc),
drawn as (select rid, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n from s where n_features >= 20)
select doc_id, n_features, weight, score, case when rank <= 10 * n // 100 then rank end as rank from s left join drawn using (rid)
"""


def queries():
    return {name: f for name, f in globals().items() if name.startswith(("op", "quality_rules_")) and callable(f)}


def oracle_sql():
    return {"op5_quality_rules": OP5_SQL.replace("LIMIT", "0.01"), "quality_rules_loose": OP5_SQL.replace("LIMIT", "0.1"), "op7_url_filter": OP7_SQL, "op11_source_divergence": OP11_SQL, "op13_importance_resampling": OP13_SQL}
