"""Queries over whole lines, rows and conversations, and the SQL they are checked by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulemart.llm import line_dedup, merkle, prefix_trie


def trie_of_openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefixes of all conversations, each begun with some turns of the first of its hundred."""
    turns = prefix_trie.hashed_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    conv = F.col("conv")
    rebuilt = prefix_trie.with_shared_openings(turns, F.crc32(conv.cast("string")) % 6, conv - conv % 100)
    return prefix_trie.prefix_nodes(*rebuilt)


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of an ASCII text, bit by bit."""
    step = "list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))"
    bytes_ = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::bigint)"
    return f"xor(list_reduce(list_concat([4294967295::bigint], {bytes_}), lambda c, x: {step}), 4294967295)"


TRIE_SQL = f"""
with turns as (
    select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, role) as place,
        coalesce(role, '') as role, coalesce(text, '') as text
    from conversations where conv_id is not null
), convs as (
    select c, count(*) as n, {_crc32("c::varchar")} % 6 as h, c - c % 100 as base from turns group by c
), openings as (
    select v.*, least(v.h, coalesce(b.n, 0)) as given from convs v left join convs b on b.c = v.base
), rebuilt as (
    select v.c, t.place as d, t.role, t.text from openings v join turns t on t.c = v.base and t.place <= v.h
    union all
    select v.c, v.given + t.place - v.h, t.role, t.text from openings v join turns t on t.c = v.c and t.place > v.h
), prefixes as (
    select a.c, a.d, any_value(a.text) as last, string_agg(md5(md5(b.role) || md5(b.text)), ',' order by b.d) as p
    from rebuilt a join rebuilt b on b.c = a.c and b.d <= a.d group by a.c, a.d
    union all select c, 0, '', '' from convs
), nodes as (
    select p, d, min(c) as conv_id, count(*) as n_convs, (count(*) - 1) * length(any_value(last)) as own from prefixes group by p, d
), placed as (  -- a node lies on the path of its smallest conversation, and of its parent that conversation tells the text
    select n.*, up.p as up from nodes n left join prefixes up on up.c = n.conv_id and up.d = n.d - 1
), counted as (
    select n.*, coalesce(k.n, 0) as n_children from placed n left join (select up, count(*) as n from placed where d > 0 group by up) k on k.up = n.p
), below as (
    select a.p, sum(u.own) as saved, count(*) filter (u.n_children = 0) as leaves
    from counted u join prefixes a on a.c = u.conv_id and a.d <= u.d group by a.p
), ends as (
    select p, string_agg(c::varchar, ',' order by c) as ids from (select c, arg_max(p, d) as p from prefixes group by c) group by p
)
select n.conv_id, n.d::bigint as depth, u.conv_id as parent_conv_id, n.n_convs, n.n_children, b.leaves as n_leaves,
    b.saved::bigint as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from counted n join below b on b.p = n.p left join nodes u on u.p = n.up left join ends e on e.p = n.p
"""


def deduplicated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that three documents or more share, but for the last that has them."""
    kept = line_dedup.drop_shared_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


LINES_SQL = """
with docs as (
    select row_number() over () as rn, doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents
), lines as (
    select rn, doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as i from docs
), keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines
), shared as (
    select key, max(doc_id) as keeper from keyed where length(key) >= 20
    group by key having count(distinct coalesce(doc_id::varchar, 'none')) >= 3
), judged as (
    select k.*, s.key is not null and k.doc_id is distinct from s.keeper as gone from keyed k left join shared s on s.key = k.key
)
select any_value(doc_id) as doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from judged group by rn
"""

_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def verified_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof in the hash tree of its source and of all, tried on texts of which some lost their line feeds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    is_cut = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = F.when(is_cut, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    values = [F.col(c) for c in _FIELDS]
    leaves = docs.select("doc_id", "source", merkle.leaf_digest(*values).alias("leaf"), merkle.leaf_digest(*values[:-1], changed).alias("claim"))
    proved = merkle.manifest(leaves).withColumn("folded_root", merkle.folded(F.col("claim"), F.col("path")))
    return proved.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _leaf_sql(text: str) -> str:
    parts = [f"case when {v} is null then '-' else octet_length(encode({v}::varchar)) || ':' || {v} end" for v in (*_FIELDS[:-1], text)]
    return f"sha256({' || '.join(parts)})"


_UP = "list_transform(range(0, (len(nodes) + 2) // 3), lambda r: sha256(array_to_string(nodes[3 * r + 1 : 3 * r + 3], '')))"
_BEFORE = "array_to_string(l.nodes[3 * (w.i // 3) + 1 : w.i], '')"
_AFTER = "array_to_string(l.nodes[w.i + 2 : 3 * (w.i // 3) + 3], '')"

MERKLE_SQL = f"""
with recursive leaves as (
    select rn, doc_id, source, leaf, claim, row_number() over (partition by source order by doc_id nulls first, leaf, rn) - 1 as i
    from (select row_number() over () as rn, doc_id, source, {_leaf_sql("text")} as leaf,
        {_leaf_sql("(case when " + _crc32("doc_id::varchar") + " % 2 = 0 then replace(text, chr(10), '') else text end)")} as claim
        from documents)
), levels as (
    select source, 0 as j, list(leaf order by i) as nodes from leaves group by source
    union all
    select source, j + 1, {_UP} from levels where len(nodes) > 1
), subroots as (
    select source, nodes[1] as subroot, row_number() over (order by source nulls first) - 1 as i from levels where len(nodes) = 1
), tree as (
    select 0 as j, list(subroot order by i) as nodes from subroots
    union all
    select j + 1, {_UP} from tree where len(nodes) > 1
), walk as (
    select rn, source, 0 as j, i, claim as node, '' as proof from leaves
    union all
    select w.rn, w.source, w.j + 1, w.i // 3, sha256({_BEFORE} || w.node || {_AFTER}), w.proof || {_BEFORE} || {_AFTER}
    from walk w join levels l on l.source is not distinct from w.source and l.j = w.j where len(l.nodes) > 1
), onward as (
    select w.rn, 0 as j, s.i, w.node, w.proof, s.subroot
    from (select rn, source, arg_max(node, j) as node, arg_max(proof, j) as proof from walk group by rn, source) w
    join subroots s on s.source is not distinct from w.source
    union all
    select w.rn, w.j + 1, w.i // 3, sha256({_BEFORE} || w.node || {_AFTER}), w.proof || {_BEFORE} || {_AFTER}, w.subroot
    from onward w join tree l on l.j = w.j where len(l.nodes) > 1
), folded as (
    select rn, subroot, arg_max(node, j) as folded_root, arg_max(proof, j) as proof from onward group by rn, subroot
)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, folded_root, folded_root = root as verified
from leaves join folded using (rn) cross join (select nodes[1] as root from tree where len(nodes) = 1)
"""

#: name -> (query, SQL)
QUERIES = {
    "op11_prefix_trie": (trie_of_openings, TRIE_SQL),
    "op12_line_dedup": (deduplicated_lines, LINES_SQL),
    "op13_merkle_manifest": (verified_manifest, MERKLE_SQL),
}
