"""Registered queries of this package and the SQL that DuckDB can run for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    chat, decontaminate, dual_tree, ngram_quality, pii, quality_rules, secret_scan, sentencepiece_codec, sharding, simhash, toxicity, warc, whitening,
)
from ledgerloom.session import durable, row_keys

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> sentencepiece_codec.Model:
    import public_tokenizers

    return sentencepiece_codec.Model.of(public_tokenizers.path("piece_bpe_32k.model"))


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piece_model()
    return sentencepiece_codec.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model, decoded="decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = durable(quality_rules.statistics(table(spark, sf_dir, "documents")))
    trees = quality_rules.fit(stats, table(spark, sf_dir, "labels"))
    failed = F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")
    return quality_rules.with_scores(stats, trees).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("score") >= 0.5)).alias("kept"), "score")


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op7_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_quality.judge(row_keys(table(spark, sf_dir, "documents"), "__row"), table(spark, sf_dir, "labels"), key="__row")


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLES["op4_decontamination"] = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
bw as (
  select distinct item_id, least(10, len(w)) n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') t
  from (select item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) i from b where len(w) > 0)),
dw as (
  select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') t
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i
        from d, (select distinct n from bw) where len(w) >= n)),
hit as (select doc_id, i, dw.n, item_id from dw join bw on bw.t = dw.t and bw.n = dw.n),
pos as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from hit) group by 1),
its as (select doc_id, count(distinct item_id) n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) l
        from hit group by 1)
select d.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit,
  cast(coalesce(n_items, 0) as bigint) n_items, sha256(coalesce(l, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join pos using (doc_id) left join its using (doc_id)
"""


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _listed(spans: str, where: str = "true") -> str:
    return f"array_join(transform(filter({spans}, s -> {where}), s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.selectExpr(
        "doc_id", *[f"cast(size(filter(spans, s -> s.base and s.kind = '{k}')) as bigint) as n_{k}" for k in pii.KINDS[:4]],
        f"sha2({_listed('spans', 's.base')}, 256) as base_sha256", f"{_listed('spans')} as spans",
        "array_join(transform(spans, s -> format_string('%.2f', s.score)), ',') as scores")


def _pii_sql() -> str:
    """Matches are marked and the text split at the marks, as RE2 has no positions either."""
    kinds = " union all ".join(
        f"select doc_id, '{k}' kind, {n} ord, string_split(regexp_replace(t, '({pii.PLAIN[k]})', chr(1) || '\\1' || chr(1), 'g'), chr(1)) p, "
        f"'(?i)(^|[^a-z])({pii.WORDS[k]})($|[^a-z])' words from d" for n, k in enumerate(pii.KINDS))
    digit = "cast(substr(digits, cast(length(digits) - j as bigint), 1) as integer)"
    powers = [pow(10, k, 97) for k in range(80)]
    listed = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by ord, s){}, '')"
    counts = ", ".join(f"count(*) filter (base and kind = '{k}') n_{k}" for k in pii.KINDS[:4])
    return f"""
with d as (select row_number() over () r, doc_id, replace(coalesce(text, ''), chr(1), chr(2)) t from documents),
parts as (select doc_id, kind, ord, words, unnest(p) x, unnest(range(len(p))) i from ({kinds})),
placed as (
  select doc_id, kind, ord, words, x m, i, sum(length(x)) over w - length(x) s, sum(length(x)) over w e,
    right(lag(x) over w, {pii.BEFORE}) || ' ' || left(lead(x) over w, {pii.AFTER}) near
  from parts window w as (partition by doc_id, kind order by i)),
found as (
  select *, regexp_replace(m, '[^0-9]', '', 'g') digits, replace(m, ' ', '') bare from placed where i % 2 = 1),
numbers as (
  select *, substr(bare, 5) || substr(bare, 1, 4) moved from found),
tested as (
  select *, array_to_string([case when c between '0' and '9' then c else cast(ascii(c) - 55 as varchar) end for c in string_split(moved, '')], '') long,
    list_sum([case when j % 2 = 0 then {digit} else {digit} * 2 - case when {digit} > 4 then 9 else 0 end end for j in range(length(digits))]) % 10 = 0 luhn
  from numbers),
verdict as (
  select *, case kind when 'email' then true when 'phone' then length(digits) between 8 and 15 when 'card' then length(digits) between 16 and 19 and luhn
      when 'ip' then list_bool_and([length(ltrim(q, '0')) <= 3 and coalesce(try_cast(ltrim(q, '0') as integer), 0) <= 255 for q in string_split(m, '.')])
      else false end base,
    case kind when 'card' then length(digits) between 13 and 19 and luhn
      when 'ip' then list_bool_and([length(ltrim(q, '0')) <= 3 and coalesce(try_cast(ltrim(q, '0') as integer), 0) <= 255 for q in string_split(m, '.')])
      when 'iban' then length(bare) between 15 and 34
        and list_sum([cast(substr(long, cast(length(long) - j as bigint), 1) as integer) * ({powers})[j + 1] for j in range(length(long))]) % 97 = 1
      else false end confirmed
  from tested),
scored as (
  select *, case when confirmed then {pii.CONFIRMED} else {pii.PROPOSED} end + case when regexp_matches(near, words) then {pii.CONTEXT} else 0 end score from verdict),
kept as (
  select * from scored where base or kind = 'iban' and confirmed and score >= {pii.LEAST} or kind = 'card' and confirmed and score > {pii.CONFIRMED}),
per_doc as (
  select doc_id, {counts}, sha256({listed.format(' filter (base)')}) base_sha256, {listed.format('')} spans,
    coalesce(string_agg(printf('%.2f', score), ',' order by ord, s), '') scores
  from kept group by 1)
select d.doc_id, {', '.join(f'coalesce(n_{k}, 0) n_{k}' for k in pii.KINDS[:4])}, coalesce(base_sha256, sha256('')) base_sha256,
  coalesce(spans, '') spans, coalesce(scores, '') scores
from d left join per_doc using (doc_id)
"""


ORACLES["op9_pii"] = _pii_sql()


@query
def op6_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


ORACLES["op6_chat_perspectives"] = r"""
with said as (select conv_id, turn, coalesce(role, 'unknown') who, coalesce(text, '') content from conversations),
people as (select distinct conv_id, who perspective from said where who <> 'system'),
roles as (
  select s.conv_id, perspective, turn, who, content,
    case when who = perspective then 'assistant' when who = 'system' then 'system' else 'user' end "role"
  from said s join people p on s.conv_id is not distinct from p.conv_id),
rendered as (
  select *, case when "role" = 'user' then who end "name",
    '<|im_start|>' || "role" || case when "role" = 'user' then ' name=' || who else '' end || chr(10) head from roles),
placed as (
  select *, head || content || '<|im_end|>' || chr(10) whole,
    row_number() over w - 1 pos, sum(length(head || content || '<|im_end|>' || chr(10))) over w - length(head || content || '<|im_end|>' || chr(10)) lead_in
  from rendered window w as (partition by conv_id, perspective order by turn nulls first, who, content rows unbounded preceding))
select conv_id, perspective, turn, cast(pos as bigint) "position", "role", "name", whole "text",
  cast(lead_in + length(head) as bigint) "start", cast(lead_in + length(head) + length(content) as bigint) "end", "role" = 'assistant' trained
from placed
"""


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.learn(docs))
    return found.selectExpr(
        "doc_id", *[f"cast(size(filter(secrets, s -> s.kind = '{k}')) as bigint) as n_{k}" for k in secret_scan.KINDS[:3]],
        f"sha2({_listed('secrets', chr(39) + 'format' + chr(39) + ' <> s.kind')}, 256) as base_sha256", f"{_listed('secrets')} as spans")


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    index = warc.write(pages, warc.folder_for(pages))
    return warc.read(index, payload=False).select(
        "page_id", F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"))


ORACLES["op10_warc"] = r"""
with p as (select page_id, encode(coalesce(html, '')) b, sha1(coalesce(html, '')) h from pages),
d as (
  select page_id, octet_length(b) n, min(page_id) over (partition by h) f,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((cast('0x' || substr(h, 1 + 5 * (i // 4), 5) as integer) >> (15 - 5 * (i % 4))) & 31), 1) for i in range(32)], '') digest
  from p)
select page_id, cast(n as bigint) payload_bytes, digest payload_digest,
  case when page_id = f then 'response' else 'revisit' end record_type, case when page_id <> f then f end refers_to
from d
"""


SHARDS = 16


@query
def op11_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), shards=SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _shards_sql(shards: int, points: int) -> str:
    """The rounds written out: in each, the rows that are left of every arc are offered to its next shard."""
    offer = """
o{r} as materialized (
  select l.arc, p.shard, l.n, l.done, coalesce(h.held, 0) held,
    cast(sum(l.n - l.done) over (partition by p.shard order by l.arc) - (l.n - l.done) as bigint) ahead
  from l{r} l join prefs p on p.arc = l.arc and p.turn = {r} left join h{r} h on h.shard = p.shard),
t{r} as materialized (
  select o.arc, o.shard, o.n, o.done, greatest(0, least(o.n - o.done, c.room - o.held - o.ahead)) take, o.held + least(o.ahead, c.room - o.held) slot
  from o{r} o join caps c using (shard)),
l{q} as materialized (select arc, n, done + take done from t{r}),
h{q} as materialized (select shard, cast(sum(held) as bigint) held from (
  select shard, held from h{r} union all select shard, take from t{r}) group by 1)"""
    rounds = ",".join(offer.format(r=r, q=r + 1) for r in range(shards))
    parts = " union all ".join(f"select arc, shard, done first, done + take last, slot from t{r} where take > 0" for r in range(shards))
    return f"""
with recursive tab(n, k, c) as (
  select cast(n as bigint), 0, cast(n as bigint) from range(256) r(n)
  union all select n, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from tab where k < 8),
crc as (select list(c order by n) steps from tab where k = 8),
d as materialized (
  select doc_id, octet_length(encode(coalesce(text, ''))) + 1 size,
    xor(list_reduce(list_prepend(4294967295::bigint, [cast('0x' || b as bigint) for b in regexp_extract_all(hex(encode(coalesce(text, ''))), '..')]),
      lambda c, b: xor(c >> 8, steps[cast(xor(c, b) & 255 as int) + 1])), 4294967295) crc,
    cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) pos
  from documents, crc),
nodes as materialized (
  select row_number() over (order by pos, shard) - 1 arc, pos, shard from (
    select s.range shard, cast('0x' || substr(md5(s.range || ':' || p.range), 1, 15) as bigint) pos from range({shards}) s, range({points}) p)),
starts as (select arc, pos from nodes union all select {shards * points}, null),
prefs as materialized (
  select arc, shard, row_number() over (partition by arc order by away) - 1 turn from (
    select a.arc, b.shard, min((b.arc - a.arc + {shards * points}) % {shards * points}) away from starts a, nodes b group by 1, 2)),
placed as materialized (
  select *, row_number() over (partition by arc order by pos, doc_id nulls first, size, crc) - 1 rank
  from (select d.*, coalesce(n.arc, {shards * points}) arc from d asof left join nodes n on d.pos <= n.pos)),
l0 as materialized (select arc, count(*) n, 0::bigint done from placed group by 1),
h0 as materialized (select range shard, 0::bigint held from range({shards})),
caps as (select range shard, n // {shards} + case when range < n % {shards} then 1 else 0 end room from range({shards}), (select count(*) n from d)),
{rounds.strip()},
parts as ({parts})
select doc_id, cast(size as bigint) size, cast(crc as bigint) text_crc32, 'rows' law, cast(p.shard as integer) shard,
  cast(slot + rank - first as bigint) slot, cast(null as integer) grown_shard
from placed join parts p on p.arc = placed.arc and rank >= first and rank < last
"""


ORACLES["op11_ring_shards"] = _shards_sql(SHARDS, sharding.POINTS)


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op13_ranked_search"] = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') w from documents),
b as (
  select row_number() over () i, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) w from benchmark),
k as materialized (select row_number() over () r, doc_id, len(w) n, w from d where len(w) > 0),
a as (select count(*) docs, cast(sum(n) as bigint) length from k),
f as materialized (select r, t, count(*) tf from (select r, unnest(w) t from k) group by 1, 2),
g as (select t, cast(floor(1000 * ln((2.0::double * docs + 2) / (2 * count(*) + 1))) as bigint) weight from f, a group by t, docs),
q as (select i, item_id, unnest(w) t from b),
s as (
  select q.i, q.item_id, k.r, k.doc_id,
    cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * k.n * docs) // length)))) as bigint) score
  from q join g using (t) join f using (t) join k on k.r = f.r, a group by 1, 2, 3, 4),
o as (select *, row_number() over (partition by i order by score desc, doc_id nulls last) place from s where score > 0)
select item_id, cast(place as integer) "rank", doc_id, score from o where place <= 10
"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
