"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtables.llm.chat import digests, prefix_examples
from logtables.llm.codes import quantise
from logtables.llm.common import remainder, table
from logtables.llm.decontamination import contamination
from logtables.llm.html_text import extract_main_text
from logtables.llm.licenses import scan_licenses
from logtables.llm.minhash import near_duplicates
from logtables.llm.negatives import hard_negatives
from logtables.llm.packing import pack_documents
from logtables.llm.quality import fit_quality, score_quality
from logtables.llm.repeats import repeated_spans
from logtables.llm.token_counts import token_counts
from logtables.llm.topk import top_k
from logtables.llm.toxicity import fit_toxicity, score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def public_vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), public_vocabulary("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), "contaminated",
    )


SQL["op4_benchmark_decontamination"] = r"""
with d as (
  select doc_id, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_az
        from documents)),
b as (
  select item_id, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from (select item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_az
        from benchmark)),
windows as (
  select distinct item_id, least(13, len(w)) as n,
         unnest(list_transform(range(1, greatest(1, len(w) - 12) + 1), lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) as win
  from b where len(w) > 0 and item_id is not null),
sizes as (select distinct n from windows),
places as (
  select doc_id, n, unnest(range(1, len(w) - n + 2)) as pos, w
  from d, sizes where len(w) >= n),
grams as (select doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') as win from places),
hits as (select g.doc_id, g.n, g.pos, x.item_id from grams g join windows x on g.win = x.win and g.n = x.n),
words as (
  select doc_id, count(distinct word) as n_hit
  from (select doc_id, unnest(range(pos, pos + n)) as word from (select distinct doc_id, n, pos from hits)) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
  from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(names, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join words using (doc_id) left join items using (doc_id)"""


#: A conversation whose texts look like the template's own marks.
MARKED = r"\### Assistant: </turn> ok"


@query
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = spark.sql("select explode(array(named_struct('turn', 0, 'role', 'user'), named_struct('turn', 1, 'role', 'assistant'))) as t")
    more = more.select(F.lit(-7).alias("conv_id"), "t.turn", "t.role", F.lit(MARKED).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(prefix_examples(turns.unionByName(more)))


SQL["op3_chat_formatting"] = rf"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '{MARKED}' union all select -7, 1, 'assistant', '{MARKED}'),
shown as (
  select *, '### ' || regexp_replace(role, '([\\#<:])', '\\\1', 'g') || ': ' || regexp_replace(text, '([\\#<])', '\\\1', 'g')
            || '</turn>' || chr(10) as segment from rows)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length(segment))::bigint as formatted_chars,
       count(*) filter (role = 'assistant') as n_examples
from shown group by conv_id"""


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query
def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


SQL["op5_exact_topk"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 5"""


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_vocabulary("piece_bpe_32k.model"))


@query
def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a directory per source, language and hundred ids, its first document the licence file."""
    name = F.when(F.col("doc_id") % 100 == 0, "LICENSE").otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), name)
    files = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    return scan_licenses(files, "path")


def toxicity_model(spark: SparkSession, sf_dir: str):
    return fit_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def quality_model(spark: SparkSession, sf_dir: str):
    return fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


@query
def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(table(spark, sf_dir, "documents"), length=400)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


#: Texts as hex digits, two for each byte; pieces of 800 bytes keep the substrings cheap.
SQL["op11_suffix_array_dedup"] = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, '')))::bigint as n from documents),
pieces as (
  select doc_id, n, k, substr(h, 800 * k + 1, 1600) as h from (select doc_id, n, h, unnest(range(0, (n - 400) // 400 + 1)) as k from d where n >= 400)),
starts as (
  select doc_id, 400 * k + i as p, md5_number(substr(h, 2 * i + 1, 800)) as s
  from (select doc_id, k, h, unnest(range(0, least(400, n - 399 - 400 * k))) as i from pieces)),
twice as (select s from starts group by s having count(*) > 1),
hits as (select doc_id, p, lag(p) over (partition by doc_id order by p) as before from starts where s in (select s from twice)),
numbered as (
  select doc_id, p, sum(case when before is null or p > before + 400 then 1 else 0 end) over (partition by doc_id order by p) as run from hits),
runs as (select doc_id, run, min(p) as a, max(p) + 400 as b from numbered group by doc_id, run),
around as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as before from runs),
cut as (
  select doc_id, sum(b - a)::bigint as n_removed, count(*) as n_spans, max(b) as stop,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) as kept
  from around join d using (doc_id) group by doc_id)
select doc_id, n as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
       sha256(unhex(case when stop is null then h else kept || substr(h, 2 * stop + 1) end)) as kept_sha256
from d left join cut using (doc_id)"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.withColumn("label", moved)
    return hard_negatives(vectors, vectors.where("vec_id % 100 = 0"))


SQL["op12_hard_negatives"] = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where label is not null and vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
         list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2]))::bigint as score
  from v a join v r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from (
    select *, row_number() over (partition by anchor_id order by score desc, vec_id) as n from scored where same) where n <= 5),
negatives as (
  select anchor_id, positive_id, positive_score, s.vec_id as negative_id, s.score as negative_score,
         row_number() over (partition by anchor_id, positive_id order by s.score desc, s.vec_id)::int as rank
  from positives p join scored s using (anchor_id)
  where not s.same and 30 * positive_score <= 100 * s.score and 100 * s.score <= 90 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= 10"""


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantise(table(spark, sf_dir, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Each round as two tables: the nearest entries, and the codebooks after it. Lists are cut and compared by component."""
    head = f"""
with v as (
  select vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (
  select vec_id, part, list_slice(v, part * (len(v) // {parts}) + 1, (part + 1) * (len(v) // {parts})) as x
  from v, (select unnest(range({parts})) as part)),
books0 as (
  select part, (row_number() over (partition by part order by vec_id) - 1)::int as entry, x as c from p
  where vec_id in (select vec_id from v order by vec_id limit {entries}))"""
    for i in range(rounds + 1):
        head += f""",
near{i} as (
  select vec_id, part, x, min_by(entry, d * {entries} + entry) as entry, min(d) as d from (
    select vec_id, p.part, x, entry, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
    from p join books{i} b on p.part = b.part) group by vec_id, part, x)"""
        if i < rounds:
            head += f""",
means{i} as (
  select part, entry, list(m order by i) as c from (
    select part, entry, i, (sum(val) - ((sum(val) % count(*)) + count(*)) % count(*)) // count(*) as m
    from (select part, entry, unnest(x)::hugeint as val, unnest(range(len(x))) as i from near{i}) group by part, entry, i)
  group by part, entry),
books{i + 1} as (select b.part, b.entry, coalesce(m.c, b.c)::bigint[] as c from books{i} b left join means{i} m using (part, entry))"""
    return head + f""",
coded as (
  select vec_id, string_agg(printf('%02x', entry), '' order by part) as code, sum(d)::bigint as error from near{rounds} group by vec_id)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
       (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) from books{rounds}) as codebooks_sha256
from coded join v using (vec_id)"""


SQL["op13_vector_codes"] = _codes_sql()
