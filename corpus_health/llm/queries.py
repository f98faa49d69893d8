"""The operators over the whole `documents` table with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpus_health.llm import bpe, fingerprints, jaccard, language, mixing, periods, quality, repeats, secrets, sharding, spelling, weaklabels, windows

RANKS = "byte_bpe_50k.tiktoken"
SHARDS = [f"shard-{i:03d}" for i in range(256)]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", sharding.slot("doc_id").alias("slot"))
    return sharding.assign(docs, SHARDS)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_all(documents(spark, sf_dir))


def op3_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weaklabels.classify(documents(spark, sf_dir))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path(RANKS))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(documents(spark, sf_dir))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(documents(spark, sf_dir))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(documents(spark, sf_dir))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(documents(spark, sf_dir))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(documents(spark, sf_dir), drop=31))


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digest(periods.echo(documents(spark, sf_dir)))


def op13_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.digest(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding, op2_language, op3_weak_labels, op4_bpe, op5_jaccard, op6_mix, op7_repeats, op8_fingerprints,
        op9_quality, op10_secrets, op11_spelling, op12_periods, op13_windows,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op6_mix": """
with counts as (select source, count(*) n from documents group by source),
rates as (select source, (select count(*) from documents)::double / (select count(*) from counts) / n as rate from counts),
steps as (
  select source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) over (partition by source order by k) as cdf
  from rates, generate_series(0, 80) g(k)
),
tables as (select source, list(cdf order by k) as cdfs from steps group by source),
drawn as (
  select d.*, len(list_filter(cdfs, lambda c: u >= c)) as copies
  from (select *, ('0x' || substr(md5('mix-1|' || doc_id || '|0'), 1, 13))::bigint / 4503599627370496.0 as u from documents) d
  join tables t on d.source is not distinct from t.source
),
each as (select * exclude (u, copies), unnest(range(copies))::int as copy from drawn)
select *, ('0x' || substr(md5('mix-1/place|' || doc_id || '|' || copy), 1, 15))::bigint as place from each
""",
}
