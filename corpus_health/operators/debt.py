"""Patterns behind information debt."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_health import constants as c
from corpus_health.functions import text
from corpus_health.functions.measures import gb, pct


def departed_user_content(files: DataFrame, accounts: DataFrame) -> DataFrame:
    """Content whose last editor has no enabled account, per site and user.

    Files are summed per (site, user) before accounts are looked up, so a user
    who touched most files costs one row per site in the join.
    """
    by_user = (
        files.where("modified_by IS NOT NULL AND site_url IS NOT NULL")
        .groupBy("site_url", "modified_by")
        .agg(F.count("*").alias("files"), F.sum("size_bytes").alias("bytes"))
    )
    # an account listed more than once is enabled if one of its lines says so
    known = accounts.groupBy(F.col("account").alias("modified_by")).agg(
        F.bool_or("enabled").alias("enabled")
    )
    state = F.when(F.col("enabled").isNull(), "unknown").otherwise("disabled")
    return (
        by_user.join(known, "modified_by", "left")
        .where(~F.coalesce("enabled", F.lit(False)))
        .select("site_url", "modified_by", "files", "bytes", gb("bytes").alias("gb"),
                state.alias("account_state"))
    )


def unarchived_junk(
    files: DataFrame, as_of: datetime, names: Iterable[str] = tuple(c.JUNK_FOLDERS)
) -> DataFrame:
    """Folders marked as discarded that still hold content, and days since their last change."""
    junk = files.where(text.in_folder_named(F.col("folder"), names))
    found = junk.groupBy("site_url", "folder").agg(
        F.count("*").alias("files"),
        F.sum("size_bytes").alias("bytes"),
        F.max("modified_ts").alias("last_modified"),
    )
    day = F.lit(as_of.date())
    return found.withColumns(
        {"gb": gb("bytes"), "days_idle": F.datediff(day, F.col("last_modified").cast("date"))}
    )


def zip_emission(files: DataFrame) -> DataFrame:
    """Share of zips in each site and top folder: content issued as archives."""
    is_zip = F.col("ext") == "zip"
    sums = (
        files.where("site_url IS NOT NULL")
        .groupBy("site_url", text.top_folder(F.col("folder")).alias("top_folder"))
        .agg(
            F.count("*").alias("files"),
            F.count_if(is_zip).alias("zips"),
            F.sum("size_bytes").alias("bytes"),
            F.sum(F.when(is_zip, F.col("size_bytes")).otherwise(0)).alias("zip_bytes"),
        )
    )
    return sums.withColumns(
        {"pct_zips": pct("zips", "files"), "pct_zip_bytes": pct("zip_bytes", "bytes")}
    )


def external_sharing_in_channels(sites: DataFrame) -> DataFrame:
    """Internal channels that people outside can be invited to."""
    channel = text.starts_with_any(F.col("template"), ["TEAMCHANNEL"])
    open_ = ~F.coalesce(F.col("sharing").isin(c.CONTROLLED_SHARING), F.lit(False))
    return sites.where(channel & F.col("sharing").isNotNull() & open_)
