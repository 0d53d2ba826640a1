"""One query per operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldlake.llm.boilerplate import MAX_RATIO, MIN_PAGES, drop_boilerplate, tag_lines, url_host
from fieldlake.llm.bpe import encode_documents
from fieldlake.llm.codes import ENTRIES, PARTS, ROUNDS, SCALE, books_sha256, product_codes, with_label_error
from fieldlake.llm.common import WORD, table
from fieldlake.llm.embeddings import THRESHOLD, embedding_components
from fieldlake.llm.mixing import mix
from fieldlake.llm.packing import pack_documents
from fieldlake.llm.quality import score_documents
from fieldlake.llm.runs import periodic_runs
from fieldlake.llm.sharding import shard_documents
from fieldlake.llm.simhash import simhash_components
from fieldlake.llm.spotsigs import edited_likeness
from fieldlake.llm.substring_dedup import LENGTH as REPEAT_WORDS, remove_repeats as remove_repeated_words
from fieldlake.llm.suffix_dedup import remove_repeats as remove_repeated_bytes

RANKS = "byte_bpe_50k.tiktoken"
WORD_MODEL = "word_bpe_49k.json"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies"
    )


def op2_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings"))


def op3_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(table(spark, sf_dir, "documents"))


def op4_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        "page_id", url_host(F.col("url")).alias("host"), tag_lines(F.col("html")).alias("text")
    )
    return drop_boilerplate(pages, F.col("host"), counts_as="n").select(
        "page_id", "host", F.col("n.lines").alias("n_lines"), F.col("n.dropped").alias("n_dropped"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def op6_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "home_shard",
    )


def op7_repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN,
        outputs=("ids_sha256", "decoded_sha256"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_product_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = product_codes(table(spark, sf_dir, "embeddings"))
    return with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256")
    )


def planted_period(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in the documents whose id's checksum ends in 0, the words from some place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    told = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), h.alias("h"), F.floor(h / 10).alias("g"))
    split = told.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    n = F.size("w")
    placed = split.withColumn("a", F.col("g") % F.nullif(n, F.lit(0)))
    period = placed.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    rest = n - F.col("a")
    again = F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int"))
    words = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(F.flatten(again), F.lit(1), rest))
    return period.select("doc_id", F.when(n > 0, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted_period(table(spark, sf_dir, "documents")))
    order = F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
    ))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    best = found.withColumn("best", F.array_max(order))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_MODEL))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    each = (
        op1_mix_sources, op2_embedding_near_duplicates, op3_spot_signatures, op4_repeated_bytes, op5_site_lines,
        op6_ring_shards, op7_repeated_words, op8_simhash, op9_bpe, op10_quality,
        op11_product_codes, op12_periodic_runs, op13_harmonic_packing,
    )
    return {f.__name__: f for f in each}


EMBEDDINGS_SQL = f"""
with recursive usable as (
    select vec_id, label, embedding::double[] as v from embeddings
    where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as (
    select a.vec_id as a, b.vec_id as b from usable a join usable b
    on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
    where list_cosine_similarity(a.v, b.v) >= {THRESHOLD}
),
reach as (
    select vec_id as node, vec_id as seen from embeddings where vec_id is not null
    union select r.node, l.b from reach r join links l on r.seen = l.a
),
least as (select node, min(seen) as component_id from reach group by node),
counts as (select a, count(*) as n from links group by a)
select e.vec_id, coalesce(c.n, 0) as n_links, l.component_id,
       coalesce(e.vec_id = l.component_id, true) as kept
from embeddings e left join least l on e.vec_id = l.node left join counts c on e.vec_id = c.a
"""

_TRIMMED = r"trim(x, E' \t\r')"
SITE_LINES_SQL = f"""
with p as (
    select page_id, lower(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '')) as host,
           regexp_replace(html, '<[^>]*>', E'\\n', 'g') as text
    from pages
),
l as (select page_id, host, string_split(text, E'\\n') as ls from p),
totals as (select host, count(*) as pages from p group by host),
seen as (
    select host, line, count(*) as n
    from (select host, unnest(list_distinct(list_transform(ls, lambda x: {_TRIMMED}))) as line from l)
    where line <> '' group by host, line
),
common as (
    select s.host, list(s.line) as bad from seen s join totals t on s.host is not distinct from t.host
    where t.pages >= {MIN_PAGES} and s.n > 1 and s.n > {MAX_RATIO} * t.pages group by s.host
),
kept as (
    select page_id, l.host, ls,
           case when bad is null then ls else list_filter(ls, lambda x: not list_contains(bad, {_TRIMMED})) end as ks
    from l left join common c on l.host is not distinct from c.host
)
select page_id, host, coalesce(len(ls), 0)::bigint as n_lines,
       (coalesce(len(ls), 0) - coalesce(len(ks), 0))::bigint as n_dropped,
       case when ls is not null then sha256(coalesce(array_to_string(ks, E'\\n'), '')) end as kept_sha256
from kept
"""

REPEATED_WORDS_SQL = rf"""
with d as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
),
w as (
    select doc_id, i, list_slice(ws, i, i + {REPEAT_WORDS - 1}) as win
    from (select doc_id, ws, unnest(range(1, len(ws) - {REPEAT_WORDS - 2})) as i from d)
),
late as (
    select doc_id, i from (select doc_id, i, row_number() over (partition by win order by doc_id, i) as k from w) where k > 1
),
gone as (select distinct doc_id, unnest(range(i, i + {REPEAT_WORDS})) as i from late),
words as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as i from d),
kept as (
    select doc_id, count(*) as n, string_agg(word, ' ' order by i) as text
    from words anti join gone using (doc_id, i) group by doc_id
)
select d.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(text, '')) as kept_sha256
from d left join kept using (doc_id)
"""


def _product_codes_sql() -> str:
    """The rounds one after another: every part against every entry of its codebook."""
    steps, width = [], "(len(q) // 4)"
    for r in range(ROUNDS + 1):
        far = "list_inner_product(b.p, b.p) - 2 * list_inner_product(v.p, b.p)"
        steps.append(f"""
a{r} as materialized (
    select v.vec_id, v.part, arg_min(b.entry, ({far}, b.entry)) as entry, min({far}) + any_value(list_inner_product(v.p, v.p)) as far
    from parts v join b{r} b using (part) group by v.vec_id, v.part
)""")
        if r < ROUNDS:
            steps.append(f"""
m{r} as (
    select part, entry, i, floor(sum(p[i]) / count(*)) as x
    from a{r} join parts using (vec_id, part), (select unnest(range(1, (select max(len(p)) from parts) + 1)) as i) group by all
),
b{r + 1} as materialized (
    select part, entry, coalesce(m.p, b.p) as p
    from b{r} b left join (select part, entry, list(x order by i) as p from m{r} group by all) m using (part, entry)
)""")
    return f"""
with kept as (
    select vec_id, label, list_transform(embedding, lambda x: floor(x::double * {SCALE})) as q from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
parts as materialized (
    select vec_id, part, q[part * {width} + 1 : (part + 1) * {width}] as p from kept, (select unnest(range({PARTS})) as part)
),
seeds as (select vec_id, row_number() over (order by vec_id) - 1 as entry from kept order by vec_id limit {ENTRIES}),
b0 as materialized (select part, entry, p from parts join seeds using (vec_id)),{",".join(steps)},
coded as (
    select vec_id, string_agg(printf('%02x', entry), '' order by part) as code, sum(far)::bigint as error from a{ROUNDS} group by vec_id
),
books as (
    select sha256(string_agg(array_to_string(list_transform(p, lambda x: x::bigint), ','), ',' order by part, entry)) as h from b{ROUNDS}
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, h as codebooks_sha256
from coded join kept using (vec_id), books
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_embedding_near_duplicates": EMBEDDINGS_SQL,
        "op5_site_lines": SITE_LINES_SQL,
        "op7_repeated_words": REPEATED_WORDS_SQL,
        "op11_product_codes": _product_codes_sql(),
    }
