"""Portfolio view: size bands, report coverage and the lists built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_health import constants as c
from corpus_health.params import Params
from corpus_health.functions.measures import big_sum, gb, pct


def band(gigabytes: Column, main: float = 10.0, mid: float = 1.0) -> Column:
    return F.when(gigabytes >= main, "main").when(gigabytes >= mid, "mid").otherwise("minor")


def size_band(summary: DataFrame, main: float = 10.0, mid: float = 1.0) -> DataFrame:
    return summary.withColumn("band", band(F.col("gb"), main, mid))


def band_totals(summary: DataFrame, main: float = 10.0, mid: float = 1.0) -> DataFrame:
    """Sites, volume and share of volume per band."""
    sums = size_band(summary, main, mid).groupBy("band").agg(
        F.count("*").alias("n_sites"), big_sum("bytes").alias("bytes")
    )
    everything = Window.partitionBy()  # three rows
    return sums.select(
        "band",
        "n_sites",
        gb("bytes").alias("gb"),
        pct(F.col("bytes"), F.sum("bytes").over(everything)).alias("pct_gb"),
    )


def report_coverage(summary: DataFrame, reports: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Which report a site has: a listed one (written or not), else the newest generated one."""
    listed = _with_existence(reports, artifacts).groupBy("site_url").agg(
        F.min_by(F.struct("artifact", "exists"), "ordinal").alias("listed")
    )
    newest = artifacts.groupBy("site_url").agg(
        F.max_by("artifact", F.struct("written_ts", "artifact")).alias("generated")
    )
    is_listed = F.col("listed").isNotNull()
    return (
        summary.join(listed, "site_url", "left")
        .join(newest, "site_url", "left")
        .withColumns(
            {
                "report": F.when(is_listed, F.col("listed.artifact")).otherwise(F.col("generated")),
                "report_kind": F.when(F.col("listed.exists"), c.LISTED)
                .when(is_listed, c.LISTED_MISSING)
                .when(F.col("generated").isNotNull(), c.GENERATED),
            }
        )
        .drop("listed", "generated")
    )


def coverage_counts(coverage: DataFrame) -> DataFrame:
    kind = F.col("report_kind")
    return coverage.agg(
        F.count_if(kind.isin(c.LISTED, c.LISTED_MISSING)).alias("n_listed"),
        F.count_if(kind == c.GENERATED).alias("n_generated"),
    )


def priority_list(reports: DataFrame, summary: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Listed reports in configured order with volume, destination and state."""
    state = F.col("state") if "state" in reports.columns else F.lit(None)
    listed = _with_existence(reports, artifacts).withColumn(
        "state", F.coalesce(state, F.lit(c.DEFAULT_REPORT_STATE))
    )
    sizes = summary.select("site_url", "site", "gb")
    return (
        listed.join(sizes, "site_url", "left")
        .select("ordinal", "site_url", "site", "gb", "destination", "state", "artifact", "exists")
        .orderBy("ordinal", "site_url")
    )


def band_listing(
    coverage: DataFrame, band_name: str | None = None, main: float = 10.0, mid: float = 1.0
) -> DataFrame:
    """Sites of one band, or of all, largest first.

    The main band leaves listed sites to their own section.
    """
    listed = F.coalesce(F.col("report_kind").isin(c.LISTED, c.LISTED_MISSING), F.lit(False))
    sites = size_band(coverage, main, mid).where((F.col("band") != "main") | ~listed)
    if band_name is not None:
        sites = sites.where(F.col("band") == band_name)
    return sites.select(
        "band", "site", "site_url", "gb", "files", "pct_post", "last_modified", "recommendation",
        "report_kind", "report",
    ).orderBy(F.desc("gb"), "site_url")


def archive_listing(coverage: DataFrame, main: float = 10.0, mid: float = 1.0) -> DataFrame:
    """Sites to archive with band and report, largest first."""
    sites = coverage.where(F.col("recommendation") == c.ARCHIVE)
    return size_band(sites, main, mid).select(
        "site", "site_url", "gb", "files", "last_modified", "band", "report_kind", "report"
    ).orderBy(F.desc("gb"), "site_url")


def _with_existence(reports: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Whether the artifact of each listed report has been written."""
    written = artifacts.select("artifact").distinct().withColumn("exists", F.lit(True))
    return reports.join(written, "artifact", "left").withColumn(
        "exists", F.coalesce("exists", F.lit(False))
    )


def priority_reports(sites: DataFrame, params: Params) -> DataFrame:
    """The configured reports by site: ordinal, site_url, artifact, destination.

    Sites are matched by name. The list is configuration, so it becomes a literal in
    the plan; a name that no site has is not in the result.
    """
    entries = [
        F.struct(F.lit(i).alias("ordinal"), F.lit(s).alias("site"), F.lit(a).alias("artifact"), F.lit(d).alias("destination"))
        for i, (s, a, d) in enumerate(params.priority_reports)
    ]
    none = F.array().cast("array<struct<ordinal: int, site: string, artifact: string, destination: string>>")
    listed = F.array(*entries) if entries else none
    mine = F.filter(listed, lambda p: p["site"] == F.col("site"))
    found = sites.select("site_url", F.explode(mine).alias("p"))
    return found.select("p.ordinal", "site_url", "p.artifact", "p.destination")
