"""The language-model operators as queries over the given tables, and the SQL some are checked by."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulemart.llm import backoff, graph_search, huffman_files, jaccard_join, licenses, mixing, near_vectors, packing, quality, queries_lines, tool_calls
from joulemart.session import new_work_dir

Query = Callable[[SparkSession, str], DataFrame]


#: Documents with a lower score are rejected.
QUALITY_THRESHOLD = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_file() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def pack_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces, packed into sequences of 2,048 tokens."""
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), words_file())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from Huffman-coded files."""
    folder = new_work_dir(spark, "huffman")
    huffman_files.write_token_files(table(spark, sf_dir, "documents"), folder, words_file())
    return huffman_files.read_token_files(spark, folder)


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents repeated so that a source of n of them has a share in proportion to the root of n."""
    return mixing.poisson_mix(table(spark, sf_dir, "documents"))


MIX_SQL = """
with recursive sizes as (
    select source, count(*)::double as n, pow(count(*)::double, 0.5) as w from documents group by source
), rates as (
    select source, w / (select sum(w) from sizes) * (select sum(n) from sizes) / n as rate from sizes
), steps as (
    select source, rate, 0 as j, exp(-rate) as p, exp(-rate) as cdf from rates
    union all
    select source, rate, j + 1, p * rate / (j + 1), cdf + p * rate / (j + 1)
    from steps where j < ceil(rate + 10 * sqrt(rate) + 20)
), draws as (
    select d.*, ('0x' || substr(md5('42:1:' || d.doc_id), 1, 13))::bigint / 4503599627370496.0 as u from documents d
), counted as (
    select d.doc_id, d.text, d.lang, d.source, d.n_chars, count(*) as copies
    from draws d join steps s on d.source is not distinct from s.source and s.cdf <= d.u
    group by all
)
select doc_id, text, lang, source, n_chars, copy_no, md5('42s:' || doc_id || ':' || copy_no) as shuffle_key
from (select *, unnest(range(1, copies + 1)) as copy_no from counted)
"""

def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under 85 % similarity of 4-word shingles."""
    found = jaccard_join.similar_documents(table(spark, sf_dir, "documents"), width=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, learned without the held-out fifth."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.filter(~quality.held_out(F.col("doc_id"))))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License and rights notices of every document."""
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def near_vectors_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95."""
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest embeddings of every one whose vec_id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return graph_search.nearest(vectors, vectors.filter("vec_id % 50 = 0"))


def backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean stupid-backoff score of every document under the rest of the corpus."""
    scored = backoff.backoff_scores(table(spark, sf_dir, "documents"))
    # The order of a sum shows in its last digits.
    return scored.withColumn("score", F.round("score", 9))


BACKOFF_SQL = r"""
with rows as (
    select row_number() over () as rn, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), words as (
    select rn, unnest(w) as c, generate_subscripts(w, 1) as i from rows
), grams as (
    select rn, i, c, lag(c) over (partition by rn order by i) as b, lag(c, 2) over (partition by rn order by i) as a from words
), held1 as (
    select rn, c, sum(count(*)) over (partition by c) - count(*) as n from grams group by rn, c
), held2 as (
    select rn, b, c, sum(count(*)) over (partition by b, c) - count(*) as n from grams where b is not null group by rn, b, c
), held3 as (
    select rn, a, b, c, sum(count(*)) over (partition by a, b, c) - count(*) as n from grams where a is not null group by rn, a, b, c
), others as (
    select rn, sum(count(*)) over () - count(*) as n from words group by rn
), found as (
    select g.rn, o.n as others, h3.n as abc, h2.n as bc, h1.n as c, ab.n as ab, b.n as b
    from grams g join others o on o.rn = g.rn join held1 h1 on h1.rn = g.rn and h1.c = g.c
    left join held2 h2 on h2.rn = g.rn and h2.b = g.b and h2.c = g.c
    left join held3 h3 on h3.rn = g.rn and h3.a = g.a and h3.b = g.b and h3.c = g.c
    left join held1 b on b.rn = g.rn and b.c = g.b
    left join held2 ab on ab.rn = g.rn and ab.b = g.a and ab.c = g.b
), events as (
    select rn,
        case when abc > 0 then ln(abc::double) - ln(ab::double) when bc > 0 then ln(bc::double) - ln(b::double)
             when c > 0 then ln(c::double) - ln(others::double) else -ln(greatest(others, 1)::double) end as value,
        case when abc > 0 then 0 else (abc is not null)::int + case when bc > 0 then 0 else (bc is not null)::int + (c = 0)::int end end as steps
    from found
), sums as (
    select rn, count(*) as n_words, sum(steps)::bigint as n_backed_off, sum(value + steps * ln(0.4)) as total from events group by rn
)
select r.doc_id, coalesce(s.n_words, 0) as n_words, coalesce(s.n_backed_off, 0) as n_backed_off,
    round(s.total / s.n_words, 9) as score
from rows r left join sums s using (rn)
"""

#: What the tools take that the turns of conversations are read as calls of.
TOOLS = {
    "system": {"prompt": {"kind": "string", "required": True, "longest": 400}},
    "user": {
        "prompt": {"kind": "string", "required": True, "longest": 300},
        "words": {"kind": "integer", "required": True, "least": 10, "most": 1000},
        "follows": {"kind": "integer"},
    },
}


def link_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System and user turns as calls, the turn after each as its result, two turns before as what it needs."""
    turns = table(spark, sf_dir, "conversations")
    at = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    words = F.size(F.split("text", "[ \n]+")).cast("bigint")
    arguments = F.when(F.col("role") == "system", F.to_json(F.struct(F.col("text").alias("prompt")))).otherwise(
        F.to_json(F.struct(words.alias("words"), F.col("text").alias("prompt"), F.when(F.col("turn") >= 2, F.col("turn") - 2).alias("follows")))
    )
    calls = turns.filter("not role <=> 'assistant'").select(
        at(F.col("turn")).alias("call_id"), F.col("role").alias("name"), arguments.alias("arguments"), at(F.col("turn") - 2).alias("depends_on")
    )
    results = turns.filter("role = 'assistant'").select(
        at(F.col("turn") - 1).alias("call_id"), F.col("turn").alias("place"), F.col("text").alias("content")
    )
    return tool_calls.link_tool_calls(calls, results, TOOLS)


TOOL_SQL = r"""
with recursive calls as (
    select conv_id, turn, 'c' || conv_id || '-' || turn as call_id, role as name, text,
        len(string_split_regex(text, '[ 
]+')) as words, true as is_call
    from conversations where role is distinct from 'assistant'
), chains as (
    select c.conv_id, c.turn, 0 as depth from calls c
    where not exists (select 1 from calls p where p.conv_id = c.conv_id and p.turn = c.turn - 2)
    union all
    select c.conv_id, c.turn, depth + 1 from chains p join calls c on c.conv_id = p.conv_id and c.turn = p.turn + 2
), results as (
    select 'c' || conv_id || '-' || (turn - 1) as call_id, turn as place, text as content from conversations where role = 'assistant'
), checked as (
    select c.*, h.depth, list_filter([
        case when name is null or name not in ('system', 'user') then 'unknown tool' end,
        case when name = 'system' and length(text) > 400 then 'prompt: too long' end,
        case when name = 'user' and length(text) > 300 then 'prompt: too long' end,
        case when name = 'user' and words > 1000 then 'words: too large' end,
        case when name = 'user' and words < 10 then 'words: too small' end], lambda x: x is not null).list_sort() as found
    from calls c join chains h using (conv_id, turn)
)
select call_id, name, place, depth, len(found)::int as n_problems, array_to_string(found, '; ') as problems,
    '{"arguments":' || case when is_call is null then 'null' when name = 'system' then '{"prompt":' || to_json(text)::varchar || '}'
        else '{' || case when turn >= 2 then '"follows":' || (turn - 2) || ',' else '' end || '"prompt":' || to_json(text)::varchar || ',"words":' || words || '}' end
    || ',"content":' || coalesce(to_json(content)::varchar, 'null') || ',"id":' || to_json(call_id)::varchar || ',"name":' || coalesce(to_json(name)::varchar, 'null')
    || ',"valid":' || coalesce((len(found) = 0)::varchar, 'null') || '}' as message
from checked full join results using (call_id)
"""

#: name -> (query, SQL or None)
QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_best_fit_packing": (pack_all, None),
    "op2_hnsw_near_duplicates": (near_vectors_all, None),
    "op3_huffman_files": (token_files, None),
    "op4_poisson_mix": (mix_sources, MIX_SQL),
    "op5_tool_call_links": (link_turns, TOOL_SQL),
    "op6_license_signatures": (license_scan, None),
    "op7_robust_graph_search": (nearest_vectors, None),
    "op8_subword_quality": (quality_scores, None),
    "op9_stupid_backoff": (backoff_scores, BACKOFF_SQL),
    "op10_ngram_jaccard_join": (ngram_join, None),
    **queries_lines.QUERIES,
}
