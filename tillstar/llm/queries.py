"""The training-data operators as queries over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import (
    decontaminate, embeddings, katz, language, licenses, minhash, negatives, packing, periodic, quality, secrets, sharding, substring)
from tillstar.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op2_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


@query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.repeats(table(spark, folder, "documents"))


@query
def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op6_katz_lm(spark: SparkSession, folder: str) -> DataFrame:
    return katz.score_texts(table(spark, folder, "documents"))


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_file())


@query
def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sharding.two_pass_shuffle(docs).select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


@query
def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").withColumn("label", relabelled)
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.periodic_runs(table(spark, folder, "documents"), tails=True).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


# --- the same by all pairs, for small tables ------------------------------------------------

_REACHED = """
    reached as (
        select id, id as other from vertices
        union
        select r.id, l.b from reached r join links l on l.a = r.other)"""

ORACLES["op2_embedding_near_dedup"] = f"""
with recursive vertices as (select vec_id as id, cast(embedding as double[]) as v, label from embeddings),
    good as (
        select * from vertices where label is not null and len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
            and len(list_filter(v, lambda x: x <> 0)) > 0),
    links as (
        select a.id as a, b.id as b from good a join good b
        on a.label = b.label and len(a.v) = len(b.v) and a.id <> b.id and list_cosine_similarity(a.v, b.v) >= 0.93),
    {_REACHED}
select v.id as vec_id, (select count(*) from links l where l.a = v.id) as n_links, r.component_id, v.id = r.component_id as kept
from vertices v join (select id, min(other) as component_id from reached group by id) r on v.id = r.id"""

ORACLES["op10_minhash_near_dedup"] = f"""
with recursive words as (
        select doc_id as id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
        from documents),
    vertices as (
        select id, case when len(w) = 0 then [] else list_distinct(list_transform(
            range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) end as s
        from words),
    shingles as (select id, len(s) as n, unnest(s) as shingle from vertices),
    links as (
        select a.id as a, b.id as b from shingles a join shingles b on a.shingle = b.shingle and a.id <> b.id
        group by a.id, b.id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    {_REACHED}
select v.id as doc_id, cast(len(v.s) as bigint) as n_shingles, r.component_id, v.id = r.component_id as kept
from vertices v join (select id, min(other) as component_id from reached group by id) r on v.id = r.id"""

ORACLES["op12_hard_negatives"] = """
with vectors as (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
        from embeddings
        where label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scores as (
        select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, cast(list_inner_product(a.v, b.v) as bigint) as score
        from vectors a join vectors b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) and a.vec_id % 100 = 0),
    positives as (
        select anchor_id, other_id as positive_id, score as positive_score from scores where same
        qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, p.positive_id, cast(row_number() over (
        partition by p.anchor_id, p.positive_id order by s.score desc, s.other_id) as integer) as rank,
    s.other_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scores s
    on s.anchor_id = p.anchor_id and not s.same and 80 * p.positive_score <= 100 * s.score and 100 * s.score <= 100 * p.positive_score
qualify rank <= 5"""
