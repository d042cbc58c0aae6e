"""Queries of the operators, with the SQL that checks them where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm import exact_dedup, jaccard, license_scan, mixing, neighbours, packing, pitman_yor, prefix_trie, quality, simhash, spelling, token_files, toxicity
from tallywork.llm.common import new_folder, table

MIX_WEIGHTS = [5.0, 2.0, 1.0]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


def op2_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.scored(table(spark, sf_dir, "documents"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.searched(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP6_SQL = """
with t as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) as text_sha256 from documents),
g as (select text_sha256, min(doc_id) as keep_id, count(*) as group_size from t group by text_sha256)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256
from t join g using (text_sha256)
"""


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    token_files.write_ids(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), 1)
    return token_files.read_index(spark, folder)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), MIX_WEIGHTS)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = f"""
with docs as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size
  from documents),
{mixing.MIX_SQL}
select doc_id, size, source_size, target, copies * size as taken from mixed
"""

def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), license_scan.standard(spark))


def listed(texts: dict[str, str]) -> str:
    return ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(texts.items()))


# Every shingle of every template is looked up in every text; no window is left out.
OP9_SQL = f"""
with given(template_id, text) as (values {listed(license_scan.TEMPLATES)}),
raw as (
  select 'd' as kind, doc_id::varchar as id, doc_id, text from documents
  union all select 't', template_id, null, text from given),
cleaned as (
  select kind, id, doc_id, list_filter(string_split(regexp_replace(
    translate(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.,;:!?"''()[]*#&%$', ''),
    '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' '), lambda w: w <> '') as words
  from raw),
sized as (select *, case when len(words) < 5 then len(words) else 5 end as own_k from cleaned where len(words) > 0),
parts as (
  select kind, id, doc_id, k, unnest(range(0, len(words) - k + 1)) as place, words
  from sized, (select unnest(range(1, 6)) as k) ks
  where k <= len(words) and case when kind = 't' then k = own_k else k in (select own_k from sized where kind = 't') end),
shingles as (select kind, id, doc_id, k, place, array_to_string(words[place + 1 : place + k], ' ') as shingle from parts),
templates as (
  select id as template_id, k, count(distinct shingle) as shingles, count(*) as size, greatest(1, count(*) // 2) as step
  from shingles where kind = 't' group by id, k),
hits as (
  select d.doc_id, t.template_id, t.shingles, t.step, d.shingle,
    unnest(range(greatest(0, (d.place - t.size - t.step + 2 + t.step - 1) // t.step), d.place // t.step + 1)) as w
  from (select distinct id, k, shingle from shingles where kind = 't') x
  join templates t on t.template_id = x.id
  join shingles d on d.kind = 'd' and d.k = x.k and d.shingle = x.shingle),
held as (
  select doc_id, template_id, w * step as start, count(distinct shingle) / max(shingles)::double as held
  from hits group by doc_id, template_id, w, step)
select doc_id, template_id, max(held) as containment, min(start) as at_word, count(*) as windows
from held where held >= 0.8 group by doc_id, template_id
"""


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_similar(table(spark, sf_dir, "documents"))


# Every shingle of every document is joined with every other; links are followed to their end.
OP12_SQL = """
with recursive cut as (
  select row_number() over () as i, doc_id, list_filter(string_split(regexp_replace(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), lambda w: w <> '') as words
  from documents),
sized as (select *, least(5, len(words)) as k from cut where len(words) > 0),
placed as (select i, words, k, unnest(range(0, len(words) - k + 1)) as place from sized),
sets as (select distinct i, array_to_string(words[place + 1 : place + k], ' ') as shingle from placed),
sizes as (select i, count(*) as n from sets group by i),
shared as (select a.i as a, b.i as b, count(*) as common from sets a join sets b on a.shingle = b.shingle and a.i <> b.i group by a.i, b.i),
links as (
  select a, b from shared join sizes x on x.i = a join sizes y on y.i = b
  where 100 * common >= 80 * (x.n + y.n - common)),
reached as (select i as a, i as b from sizes union select r.a, l.b from reached r join links l on l.a = r.b)
select c.doc_id, coalesce(s.n, 0) as n_shingles, case when s.n is null then c.doc_id else m.component_id end as component_id
from cut c left join sizes s on s.i = c.i
left join (select r.a, min(d.doc_id) as component_id from reached r join cut d on d.i = r.b group by r.a) m on m.a = c.i
"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(table(spark, sf_dir, "conversations"))


# Nodes from all prefixes of all conversations, written out; the checksum bit by bit from its polynomial.
OP13_SQL = """
with told as (select conv_id::bigint as conv_id, turn, coalesce(text, '') as text, coalesce(role, '') as role from conversations where conv_id is not null),
coded as (select conv_id, turn, strlen(text) as bytes, md5(strlen(role)::varchar || ':' || role || text) as code from told),
lists as (select conv_id, list({'code': code, 'bytes': bytes} order by turn nulls first, code) as turns from coded group by conv_id),
crc as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as steps),
heads as (
  select conv_id, turns, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 9 as h
  from lists, crc),
built as (
  select a.conv_id, list_concat(coalesce(b.turns[1 : a.h], []), a.turns[a.h + 1 : ]) as turns
  from heads a left join lists b on b.conv_id = a.conv_id - a.conv_id % 5),
talks as (select conv_id, len(turns) as size, list_transform(turns, lambda t: t.code) as codes, list_transform(turns, lambda t: t.bytes) as sizes from built),
prefixes as (
  select conv_id, size, d, codes[1 : d] as node, case when d = 0 then 0 else sizes[d] end as bytes
  from (select *, unnest(range(0, size + 1)) as d from talks)),
nodes as (
  select node, d as depth, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * max(bytes) as saved,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (size = d), '')) as ends_sha256
  from prefixes group by node, d),
above as (select *, case when depth > 0 then node[1 : depth - 1] end as parent from nodes),
childs as (select parent, count(*) as n from above where parent is not null group by parent),
full_nodes as (select a.*, coalesce(c.n, 0) as n_children from above a left join childs c on c.parent = a.node),
sums as (
  select node[1 : up] as node, sum(saved) as saved_tokens, count(*) filter (n_children = 0) as n_leaves
  from (select *, unnest(range(0, depth + 1)) as up from full_nodes) group by 1)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens::bigint as saved_tokens, n.ends_sha256
from full_nodes n join sums s on s.node = n.node left join full_nodes p on p.node = n.parent
"""


QUERIES = {
    "op1_packing": op1_packing, "op2_pitman_yor": op2_pitman_yor, "op3_neighbours": op3_neighbours, "op4_quality": op4_quality, "op5_toxicity": op5_toxicity, "op6_exact_dedup": op6_exact_dedup, "op7_token_files": op7_token_files,
    "op8_mixing": op8_mixing, "op9_license_scan": op9_license_scan, "op10_simhash": op10_simhash,
    "op11_spelling": op11_spelling, "op12_ngram_jaccard": op12_ngram_jaccard, "op13_prefix_trie": op13_prefix_trie,
}
CHECKS = {"op6_exact_dedup": OP6_SQL, "op8_mixing": OP8_SQL, "op9_license_scan": OP9_SQL, "op12_ngram_jaccard": OP12_SQL, "op13_prefix_trie": OP13_SQL}
