"""The registered text queries, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tillroll.llm import (
    chat, cotraining, decontamination, html_layout, licenses, line_dups, merkle, mixing, token_alignment, toxicity,
    tree_rules)
from tillroll.llm.near_dups import near_duplicates
from tillroll.llm.sharding import shard_table
from tillroll.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    """Register under the function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir.rstrip("/"))

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_cotrained_quality(spark, d):
    docs = table(spark, d, "documents").select("doc_id", *cotraining.INPUTS)
    model = cotraining.fit(docs, table(spark, d, "labels"))
    return cotraining.with_quality(docs, model, keep=["doc_id"]).select("doc_id", "quality.*")


@query
def op2_boosted_tree_rules(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    forest = tree_rules.fit(docs, table(spark, d, "labels"))
    return tree_rules.with_rules(docs, forest, keep=["doc_id"]).select("doc_id", "rules.*")


@query
def op3_license_digests(spark, d):
    found = licenses.with_licenses(table(spark, d, "documents"), licenses.builtin(spark))
    return found.withColumn("notices", F.array_join("notices", ","))


@query
def op4_chat_formatting(spark, d):
    probe = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.read_back(chat.formatted_turns(chat.text_parts(rows)))


@query
def op5_html_layout(spark, d):
    return html_layout.with_text(table(spark, d, "pages"), keep=["page_id"])


@query
def op6_factorization_toxicity(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    machine = toxicity.fit(docs, table(spark, d, "labels"))
    scored = toxicity.with_toxicity(docs, machine, keep=["doc_id"])
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "toxicity.*")


@query
def op7_pfair_mixing(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    return mixing.mixed(docs).select("doc_id", "source", "mix.*")


@query
def op8_minhash_near_duplicates(spark, d):
    return near_duplicates(table(spark, d, "documents"), words=2, percent=80)


@query
def op9_histogram_sharding(spark, d):
    return shard_table(table(spark, d, "documents"))


@query
def op10_benchmark_decontamination(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = decontamination.with_leaks(docs, table(spark, d, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "leak.*")


@query
def op11_pointer_jumping_alignment(spark, d):
    return token_alignment.alignment(table(spark, d, "documents"))


@query
def op12_line_dedup(spark, d):
    found = line_dups.with_lines(table(spark, d, "documents").select("doc_id", "text"), keep=["doc_id"])
    return found.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.kept", 256).alias("kept_sha256"))


@query
def op13_merkle_manifest(spark, d):
    return merkle.manifest(table(spark, d, "documents"))


@query
def pipeline(spark, d):
    return corpus_pipeline.run(spark, d)


ORACLE: dict[str, str] = {}

ORACLE["op8_minhash_near_duplicates"] = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents),
sets as (
  select doc_id, case when len(w) < 2 then list_distinct([array_to_string(w, ' ')])
         else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s,
         len(w) as n
  from words),
sized as (select doc_id, case when coalesce(n, 0) = 0 then 0 else len(s) end as n_shingles, s from sets),
grams as (select doc_id, n_shingles, unnest(s) as g from sized where n_shingles > 0),
links as (
  select a.doc_id as a, b.doc_id as b
  from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id
       and 100 * least(a.n_shingles, b.n_shingles) >= 80 * greatest(a.n_shingles, b.n_shingles)
  group by a.doc_id, b.doc_id, a.n_shingles, b.n_shingles
  having 100 * count(*) >= 80 * (a.n_shingles + b.n_shingles - count(*))),
ways as (select a, b from links union all select b, a from links),
reach(doc_id, seen) as (
  select doc_id, doc_id from sized
  union
  select w.b, r.seen from reach r join ways w on w.a = r.doc_id where r.seen < w.b)
select s.doc_id, s.n_shingles::bigint as n_shingles, min(r.seen)::bigint as component_id,
       min(r.seen) = s.doc_id as kept
from sized s join reach r on r.doc_id = s.doc_id
group by s.doc_id, s.n_shingles
"""

_SPELLED = "x"
for _from, _to in licenses.SPELLINGS:
    _SPELLED = f"replace({_SPELLED}, '{_from}', '{_to}')"
_KNOWN = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in licenses.KNOWN)


def _lines(text: str) -> str:
    """DuckDB expression for the canonical lines of a text."""
    lowered = f"list_transform(string_split(coalesce({text}, ''), chr(10)), lambda x: replace(lower(x), '©', '(c)'))"
    plain = rf"""list_transform({lowered}, lambda x: case when regexp_matches(x, '{licenses.COPYRIGHT_LINE}') then ''
        else trim(regexp_replace({_SPELLED}, '[\x00-/:-@\[-`{{-\x7f]+', ' ', 'g')) end)"""
    return f"list_filter({plain}, lambda x: x <> '')"


ORACLE["op3_license_digests"] = f"""
with known as (
  select md5(array_to_string(lines, ' ')) as digest, min(license_id) as license_id
  from (select license_id, {_lines("text")} as lines from (values {_KNOWN}) k(license_id, text))
  where len(lines) > 0 group by 1),
docs as (select doc_id, {_lines("text")} as lines from documents),
notices as (
  select d.doc_id, string_agg(distinct k.license_id, ',' order by k.license_id) as notices
  from (select doc_id, unnest(lines) as line from docs) d join known k on k.digest = md5(d.line) group by d.doc_id)
select d.doc_id, case when len(d.lines) > 0 then md5(array_to_string(d.lines, ' ')) end as digest,
       k.license_id, coalesce(n.notices, '') as notices
from docs d
left join known k on len(d.lines) > 0 and k.digest = md5(array_to_string(d.lines, ' '))
left join notices n on n.doc_id = d.doc_id
"""

ORACLE["op4_chat_formatting"] = r"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked as (
  select *, regexp_replace(role || chr(10) || text,
       '([<\[])(\\*)(\||s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g') as escaped from said)
select conv_id::bigint as conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
  (sum(length(escaped) - 1) + 23 * count(*))::bigint as formatted_chars
from marked group by conv_id
"""

ORACLE["op12_line_dedup"] = r"""
with cut as (
  select doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as pos
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from cut),
often as (
  select k, max(doc_id) as holder from keyed where length(k) >= 40 group by k having count(distinct doc_id) >= 5),
told as (
  select c.doc_id, c.pos, c.line, coalesce(c.doc_id <> o.holder, false) as gone
  from keyed c left join often o on o.k = c.k)
select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from told group by doc_id
"""


def _encoded(*values: str) -> str:
    """DuckDB expression of the joined ``byte count:value`` fields of a leaf."""
    return " || ".join(f"case when {v} is null then '-' else strlen({v}::varchar) || ':' || {v} end" for v in values)


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_STEPS = """
  select {key}, {level} as lvl,
         array_to_string(r.hs[1 : p.idx // (16**r.lvl)::bigint % 16], '') as l,
         array_to_string(r.hs[p.idx // (16**r.lvl)::bigint % 16 + 2 :], '') as r
  from {rows} p join {runs} r on r.g is not distinct from {group} and r.run = p.idx // (16**(r.lvl + 1))::bigint"""

# CRC-32 by the usual table of 256 remainders, one byte after the other
ORACLE["op13_merkle_manifest"] = f"""
with recursive remainders as (
  select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, k: case when (c & 1) = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from range(256) r(i)),
leaves as (
  select doc_id, source as g, sha256({_encoded(*merkle.FIELDS)}) as leaf,
         sha256({_encoded(*merkle.FIELDS[:-1], _LOWERED)}) as changed,
         xor(list_reduce(list_prepend(4294967295::bigint,
             list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
             lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 5 = 0 as hit
  from documents, remainders),
placed as (
  select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as idx,
         count(*) over (partition by g) as n from leaves),
nodes(g, lvl, idx, h, n) as (
  select g, 0, idx, leaf, n from placed
  union all
  select g, lvl + 1, idx // 16, sha256(string_agg(h, '' order by idx)), (any_value(n) + 15) // 16
  from nodes where n > 1 group by g, lvl, idx // 16),
subroots as (select g, h as subroot, row_number() over (order by g nulls first) - 1 as idx,
                    count(*) over () as n from nodes where n = 1),
tops(lvl, idx, h, n) as (
  select 0, idx, subroot, n from subroots
  union all
  select lvl + 1, idx // 16, sha256(string_agg(h, '' order by idx)), (any_value(n) + 15) // 16
  from tops where n > 1 group by lvl, idx // 16),
runs as (select g, lvl, idx // 16 as run, list(h order by idx) as hs from nodes where n > 1 group by g, lvl, idx // 16),
top_runs as (select 0 as g, lvl, idx // 16 as run, list(h order by idx) as hs from tops where n > 1 group by lvl, idx // 16),
lower_steps as ({_STEPS.format(key="p.g, p.idx", level="r.lvl", rows="placed", runs="runs", group="p.g")}),
upper_steps as ({_STEPS.format(key="p.g", level="1000 + r.lvl", rows="subroots", runs="top_runs", group="0")}),
steps as (
  select g, idx, lvl, l, r from lower_steps
  union all select p.g, p.idx, u.lvl, u.l, u.r from upper_steps u join placed p on p.g is not distinct from u.g),
paths as (select g, idx, list([l, r] order by lvl) as path from steps group by g, idx),
folds as (
  select p.doc_id, p.leaf, s.subroot, (select h from tops where n = 1) as root,
         sha256(coalesce(array_to_string(list_transform(path, lambda x: x[1] || x[2]), ''), '')) as proof_sha256,
         list_reduce(list_prepend([case when hit then changed else leaf end], coalesce(path, [])),
                     lambda a, x: [sha256(x[1] || a[1] || x[2])])[1] as folded_root
  from placed p join subroots s on s.g is not distinct from p.g
  left join paths q on q.g is not distinct from p.g and q.idx = p.idx)
select *, folded_root = root as verified from folds
"""
