"""Which sites to survey again, and what the survey runs brought."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpus_health import constants as c
from corpus_health.functions import times
from corpus_health.operators import inventory
from corpus_health.params import Params
from corpus_health.plans.skew import salted_join


def last_survey(surveys: DataFrame) -> DataFrame:
    """Newest finished survey of each site."""
    done = surveys.where(F.col("status") == c.OK)
    return done.groupBy("site_url").agg(F.max("surveyed_ts").alias("surveyed_ts"))


def refresh_reason(sites: DataFrame, surveys: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Why a site is surveyed again, or `current` when it is skipped."""
    known = sites.join(last_survey(surveys), "site_url", "left")
    activity, surveyed = F.col("last_activity_ts"), F.col("surveyed_ts")
    reason = (
        F.when(surveyed.isNull(), "never")
        .when(F.lit(days >= c.FORCE_REFRESH_DAYS), "forced")
        .when(activity > surveyed, "newer")
        .when(activity >= times.days_before(as_of, days), "recent")
        .otherwise("current")
    )
    return known.withColumn("reason", reason).withColumn("run", F.col("reason") != "current")


def refresh_plan(
    sites: DataFrame, surveys: DataFrame, params: Params, days: int | None = None
) -> DataFrame:
    """Decision for every candidate site, those to run by size first."""
    candidates = inventory.refresh_candidates(sites, params)
    days = params.refresh_days if days is None else days
    plan = refresh_reason(candidates, surveys, params.today, days)
    return plan.orderBy(F.desc("run"), F.desc("storage_gb"), "site_url")


def plan_totals(plan: DataFrame) -> DataFrame:
    storage = F.sum(F.col("storage_gb").cast("decimal(18,2)")).cast("double")
    return plan.groupBy("run", "reason").agg(
        F.count("*").alias("n_sites"), storage.alias("storage_gb")
    )


def pending(sites: DataFrame, surveys: DataFrame) -> DataFrame:
    """Sites without a finished survey: where a stopped run goes on."""
    return sites.join(last_survey(surveys), "site_url", "left_anti")


def run_summary(surveys: DataFrame) -> DataFrame:
    status = F.col("status")
    return surveys.agg(
        F.count_if(status == c.OK).alias("n_ok"),
        F.count_if(status == c.SKIPPED).alias("n_skipped"),
        F.count_if(status.isin(c.NO_FILES, c.NO_LIBRARIES)).alias("n_empty"),
        F.count_if(status.startswith(c.ERROR_PREFIX)).alias("n_error"),
        F.coalesce(F.sum(F.when(status == c.OK, F.col("files"))), F.lit(0)).alias("files"),
    )


def failed_sites(surveys: DataFrame) -> DataFrame:
    return surveys.where(F.col("status").startswith(c.ERROR_PREFIX)).orderBy("run_order", "site_url")


def latest_snapshot(
    files: DataFrame,
    version: str = "survey_no",
    drop_missing: bool = False,
    runs: DataFrame | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Newest row of each file across surveys.

    Rows that tie on the version are told apart by all other columns, so the
    kept row is the same on every run. Each map task keeps one row per file
    before the shuffle, so a file seen in very many rows costs one row per task.

    `drop_missing` also drops files that the newest survey of their site no
    longer lists: a survey lists everything that exists. With `runs` (site_url,
    the version and its status), only a run that came to its end drops files: a
    file stays from the newest finished run on, and a site without one keeps all.

    `within` are columns that rows of a file have in common and are laid out by: they
    are not shuffled again then.
    """
    keys = ["site_url", "path"]
    order = [F.desc_nulls_last(version)] + [
        F.desc_nulls_last(name) for name in files.columns if name not in (*keys, *within, version)
    ]
    names, parts = files.columns, [*within, *keys]
    if drop_missing:
        # a file is kept if any row of it is recent enough, so rows that are not go first
        ended = files if runs is None else runs.where(F.col("status") == c.OK)
        last = ended.groupBy("site_url").agg(F.max(version).alias("_last"))
        how = "inner" if runs is None else "left"
        files = salted_join(files, last, ["site_url"], how, by=["path"])
        files = files.where(F.col("_last").isNull() | (F.col(version) >= F.col("_last")))
        parts = [*within, "site_url", "_salt", "path"]
    newest = Window.partitionBy(*parts).orderBy(*order)
    return files.withColumn("_n", F.row_number().over(newest)).where("_n = 1").select(*names)


def survey_rows(files: DataFrame, sites: DataFrame) -> DataFrame:
    """Run summary rebuilt from landed files; a site without files is reported as such."""
    # libraries first: two steps of small aggregates instead of a distinct over all rows
    by_library = files.groupBy("site_url", "library").agg(F.count("*").alias("n"))
    landed = by_library.groupBy("site_url").agg(
        F.count("library").alias("libraries"), F.sum("n").alias("files")
    )
    none = F.lit(0).cast("bigint")
    return (
        sites.select("site_url")
        .join(landed, "site_url", "left")
        .select(
            "site_url",
            F.coalesce("libraries", none).alias("libraries"),
            F.coalesce("files", none).alias("files"),
            F.when(F.col("files") > 0, c.OK).otherwise(c.NO_FILES).alias("status"),
        )
    )
