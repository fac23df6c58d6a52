"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.llm import (
    chat, decontaminate, filter_audit, html_blocks, language_id, nbsvm, packing, pii, pq_dedup, simhash, substring,
    suffix_dedup, turn_trie,
)
from carelattice.llm.common import held_out, ship_package, table


def _digits(fingerprint: str) -> F.Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = language_id.profiles(language_id.training_rows(docs))
    return language_id.classify(docs, known).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "margin")


def op2_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.93)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.simhash_classes(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return classes.select(
        F.col("id").alias("doc_id"), _digits("fingerprint").alias("fingerprint"), "component_id")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = nbsvm.train(docs, table(spark, sf_dir, "labels"))
    return nbsvm.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_words(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("bigint"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
        "offset", "window", "step_group")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.accepted_patterns(docs))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.listed("base").cast("binary"), 256).alias("base_sha256"),
        pii.listed("spans").alias("spans"))


# One conversation that holds the control strings of common templates.
ADDED_CONVERSATION = -7
ADDED_TEXT = "\\### Assistant: </turn> ok"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(ADDED_CONVERSATION, 0, "user", ADDED_TEXT), (ADDED_CONVERSATION, 1, "assistant", ADDED_TEXT)],
        turns.schema)
    return chat.digests(chat.format_turns(turns.unionByName(added)))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), unnamed=True)
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(
        filter_audit.failed_sets(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op12_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


def op13_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_trie.trie(turn_trie.rebuilt(table(spark, sf_dir, "conversations"))).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _with_package(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_pq": op2_pq,
    "op3_simhash": op3_simhash,
    "op4_quality": op4_quality,
    "op5_substring": op5_substring,
    "op6_html": op6_html,
    "op7_packing": op7_packing,
    "op8_pii": op8_pii,
    "op9_chat": op9_chat,
    "op10_decontaminate": op10_decontaminate,
    "op11_filter_audit": op11_filter_audit,
    "op12_suffix": op12_suffix,
    "op13_turn_trie": op13_turn_trie,
}

QUERIES = {name: _with_package(query) for name, query in _QUERIES.items()}

_WORDS10 = ("list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            "'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')")

ORACLE: dict[str, str] = {
    "op5_substring": """
with docs as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
  from documents),
windows as (
  select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as h
  from (select doc_id, w, unnest(generate_series(1, len(w) - 49)) as i from docs where len(w) >= 50)),
first as (select h, min(doc_id) as least from windows group by h),
gone as (
  select distinct doc_id, unnest(generate_series(i, i + 49)) as pos
  from windows join first using (h) where doc_id > least),
words as (select doc_id, unnest(w) as word, unnest(generate_series(1, len(w))) as pos from docs),
kept as (
  select doc_id, string_agg(word, ' ' order by pos) as text, count(*) as n
  from words anti join gone using (doc_id, pos) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(k.text, '')) as kept_sha256
from docs left join kept k using (doc_id)""",
    "op2_pq": """
with recursive v as (
  select vec_id, label, cast(embedding as double[]) as e,
    label is not null and coalesce(len(embedding), 0) > 0
      and len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)
      and len(list_filter(embedding, lambda x: x <> 0)) > 0 as usable
  from embeddings),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b
  on a.label = b.label and a.usable and b.usable and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.93),
reach as (select vec_id as a, vec_id as b from v union select r.a, l.b from reach r join links l on r.b = l.a),
component as (select a as vec_id, min(b) as component_id from reach group by a),
counts as (select a as vec_id, count(*) as n from links group by a)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from component left join counts using (vec_id)""",
    "op9_chat": r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(16 + length(regexp_replace(role, '[\\<>]', '\\\0', 'g'))
    + length(regexp_replace(text, '\\|</?turn', '\\\0', 'g'))) as bigint) as formatted_chars
from turns group by conv_id""",
    "op10_decontaminate": f"""
with items as (select item_id, {_WORDS10} as w from benchmark),
windows as (
  select distinct item_id, array_to_string(w[i:i + 12], ' ') as phrase, least(len(w), 13) as n
  from (select item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) as i from items where len(w) > 0)),
sizes as (select distinct n from windows),
docs as (select doc_id, {_WORDS10} as w from documents),
places as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as phrase
  from (select doc_id, w, unnest(generate_series(1, len(w))) as i from docs), sizes where i + n - 1 <= len(w)),
found as (select p.doc_id, p.i, p.n, x.item_id from places p join windows x using (phrase)),
hit as (
  select doc_id, count(distinct pos) as n_hit
  from (select doc_id, unnest(generate_series(i, i + n - 1)) as pos from found) group by 1),
named as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as id from found where item_id is not null) group by 1)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) as contaminated
from docs d left join hit using (doc_id) left join named using (doc_id)""",
    "op11_filter_audit": r"""
with words as (
  select doc_id, coalesce(text, '') as text, coalesce(lang, '') as part,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents),
least as (select text, min(doc_id) as first from words group by text),
marks as (select doc_id, coalesce(max(quality) = 1, false) as good, coalesce(max(toxic) = 1, false) as toxic
  from labels group by doc_id),
docs as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    (len(w) < 100)::int + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::int
    + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text))::int
    + 8 * regexp_matches(text, '[#$%&*|]')::int + 16 * coalesce(doc_id > first, false)::int as failed
  from words join least using (text) left join marks using (doc_id)),
sets as (select part, failed, good, toxic, count(*) as n from docs group by all),
letters as (select unnest(range(5)) as i),
orders as (
  select [a.i, b.i, c.i, d.i, e.i] as o from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps as (
  select list_reduce(list_transform(o, lambda x: substr('ABCDE', x + 1, 1)), lambda x, y: x || y) as filter_order,
    step, cast(1 << o[step] as int) as bit,
    cast(list_sum(list_transform(o[1:step - 1], lambda x: 1 << x)) as int) as before
  from orders, unnest(range(1, 6)) as s(step)),
counted as (
  select part, filter_order, step, bit,
    sum(n) filter (failed & (coalesce(before, 0) | bit) = 0) as kept,
    sum(n) filter (failed & coalesce(before, 0) = 0 and failed & bit <> 0) as removed,
    sum(n) filter (failed & coalesce(before, 0) <> 0 and failed & bit <> 0) as redundant,
    sum(n) filter (failed = bit) as unique_fails,
    sum(n) filter (failed & coalesce(before, 0) = 0 and failed & bit <> 0 and good) as good_lost,
    sum(n) filter (failed & coalesce(before, 0) = 0 and failed & bit <> 0 and toxic) as toxic_lost
  from sets, steps group by all)
select part, filter_order, cast(step as int) as step, cast(coalesce(kept, 0) as bigint) as kept,
  cast(coalesce(removed, 0) as bigint) as removed, cast(coalesce(redundant, 0) as bigint) as redundant,
  cast(coalesce(unique_fails, 0) as bigint) as unique_fails, cast(coalesce(good_lost, 0) as bigint) as good_lost,
  cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
  cast(sum(coalesce(removed, 0)) over (partition by part, bit) as bigint) as shapley
from counted""",
    "op12_suffix": """
with docs as (
  select row_number() over () as r, doc_id, encode(coalesce(text, '')) as b from documents),
windows as (
  select r, i, md5(b[i:i + 199]) as h
  from (select r, b, unnest(generate_series(1, octet_length(b) - 199)) as i from docs)),
twice as (select h from windows group by h having count(*) > 1),
hit as (select r, i, lag(i) over (partition by r order by i) as previous from windows semi join twice using (h)),
runs as (
  select r, i, sum(case when previous is null or i > previous + 200 then 1 else 0 end) over (partition by r order by i) as run
  from hit),
spans as (select r, min(i) as first, max(i) + 199 as final from runs group by r, run),
gaps as (
  select r, first, final, coalesce(lag(final) over (partition by r order by first), 0) as before,
    row_number() over (partition by r order by first desc) = 1 as is_last from spans),
kept as (
  select r, sum(final - first + 1) as n_removed, count(*) as n_spans,
    string_agg(case when first > before + 1 then hex(b[before + 1:first - 1]) else '' end
      || case when is_last and final < octet_length(b) then hex(b[final + 1:octet_length(b)]) else '' end, '' order by first) as x
  from gaps join docs using (r) group by r)
select doc_id, cast(octet_length(d.b) as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  cast(coalesce(n_spans, 0) as bigint) as n_spans, sha256(coalesce(unhex(k.x), d.b)) as kept_sha256
from docs d left join kept k using (r)""",
    "op13_turn_trie": """
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
    partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
  from conversations where conv_id is not null),
convs as (
  select conv_id, conv_id - conv_id % 5 as base, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(cast(conv_id as varchar), ''), lambda c: ascii(c)::bigint)),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end))) % 9 as h
  from (select distinct conv_id from turns)),
parts as (
  select c.conv_id, 0 as part, pos, role, text from convs c join turns b on b.conv_id = c.base where pos <= h
  union all
  select conv_id, 1, pos, role, text from convs join turns using (conv_id) where pos > h),
digests as (
  select conv_id, octet_length(encode(text)) as size, md5(octet_length(encode(role)) || ':' || role || text) as digest,
    row_number() over (partition by conv_id order by part, pos) as depth from parts),
paths as (
  select conv_id, depth, size, md5(string_agg(digest, '') over (partition by conv_id order by depth)) as key from digests
  union all select conv_id, 0, 0, '' from convs),
linked as (select *, lag(key) over (partition by conv_id order by depth) as parent,
  lead(depth) over (partition by conv_id order by depth) is null as is_end from paths),
nodes as (
  select key, depth, any_value(size) as size, any_value(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (is_end), '')) as ends_sha256
  from linked group by key, depth),
children as (select parent as key, count(*) as n from nodes where parent is not null group by parent),
below as (
  select distinct a.key as top, b.key from paths a join paths b on a.conv_id = b.conv_id and a.depth <= b.depth),
trees as (
  select top as key, count(*) filter (c.n is null) as n_leaves, sum((n_convs - 1) * size) as saved
  from below b join nodes n on b.key = n.key left join children c on b.key = c.key group by top)
select n.conv_id, cast(n.depth as bigint) as depth, p.conv_id as parent_conv_id, cast(n.n_convs as bigint) as n_convs,
  cast(coalesce(c.n, 0) as bigint) as n_children, cast(n_leaves as bigint) as n_leaves,
  cast(saved as bigint) as saved_tokens, n.ends_sha256
from nodes n join trees t on n.key = t.key left join children c on n.key = c.key left join nodes p on n.parent = p.key""",
}
