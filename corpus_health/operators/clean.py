"""Cleaning survey rows and deriving the columns every analysis needs.

All of it is one narrow stage: filters and projections, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_health import constants as c
from corpus_health.functions import measures, text, times
from corpus_health.params import Params


def drop_system_libraries(files: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    """Drop rows of platform libraries; a file without library stays."""
    names = [*c.SYSTEM_LIBRARIES, *extra]
    return files.where(F.col("library").isNull() | ~F.col("library").isin(names))


def drop_system_files(files: DataFrame) -> DataFrame:
    """Drop site icons; a row without file name stays."""
    return files.where(F.col("file_name").isNull() | ~F.col("file_name").isin(c.SYSTEM_FILES))


def parse_times(files: DataFrame) -> DataFrame:
    return files.withColumns(
        {name: times.parse(F.col(name)) for name in ("created_ts", "modified_ts")}
    )


def coerce_numbers(files: DataFrame) -> DataFrame:
    """Text to numbers; whatever is not a number counts as 0."""
    kinds = {"size_bytes": "bigint", "size_mb": "double", "depth": "int"}
    return files.withColumns(
        {
            name: F.coalesce(F.col(name).try_cast(kind), F.lit(0).cast(kind))
            for name, kind in kinds.items()
            if name in files.columns
        }
    )


def flag_post(files: DataFrame, migrated_at: datetime) -> DataFrame:
    """Modified strictly after the migration."""
    return files.withColumn(
        "is_post", times.after(F.col("modified_ts"), times.timestamp(migrated_at))
    )


def flag_inactive(files: DataFrame, migrated_at: datetime, years: int = 2) -> DataFrame:
    """Untouched for years before the migration."""
    return files.withColumn(
        "is_inactive", times.before(F.col("modified_ts"), times.years_before(migrated_at, years))
    )


def parse_checkout(files: DataFrame) -> DataFrame:
    """Checked-out mark as boolean; an absent column means nobody holds a file."""
    if "checked_out" not in files.columns:
        return files.withColumn("checked_out", F.lit(False))
    return files.withColumn("checked_out", F.coalesce(F.col("checked_out") == c.YES, F.lit(False)))


def clean(files_raw: DataFrame, params: Params) -> DataFrame:
    """Text rows as surveyed -> typed rows with activity flags."""
    files = drop_system_files(drop_system_libraries(files_raw))
    files = parse_checkout(coerce_numbers(parse_times(files)))
    if "depth" not in files.columns:
        files = files.withColumn("depth", F.lit(0))
    files = flag_post(files, params.migrated_at)
    return flag_inactive(files, params.migrated_at, params.inactive_years)


def categorize(files: DataFrame) -> DataFrame:
    lower = files.withColumn("_ext", F.lower("ext"))
    return lower.withColumn("category", text.category(F.col("_ext"))).drop("_ext")


def special_formats(files: DataFrame) -> DataFrame:
    """Files in a format that needs a decision, with its label and note.

    The format table has 14 fixed rows, so it is a map literal: no join.
    """
    found = files.withColumn("special", text.special_format(F.col("ext")))
    return found.where("special IS NOT NULL").select(
        "*", F.col("special.label").alias("label"), F.col("special.note").alias("note")
    ).drop("special")


def relative_path(files: DataFrame) -> DataFrame:
    """Path below the site, its folder and its depth."""
    with_rel = files.withColumn("rel_path", text.relative_path(F.col("path"), F.col("site_url")))
    return with_rel.withColumns(
        {
            "folder": text.folder_of(F.col("rel_path"), F.col("file_name")),
            "depth": text.depth_of(F.col("rel_path")),
        }
    )


def top_folder(files: DataFrame) -> DataFrame:
    return files.withColumn("top_folder", text.top_folder(F.col("folder")))


def size_units(files: DataFrame) -> DataFrame:
    return files.withColumns(
        {"size_kb": measures.kib("size_bytes"), "size_mb": measures.mib("size_bytes")}
    )


def site_slug(df: DataFrame, maxlen: int = 50) -> DataFrame:
    return df.withColumn("slug", text.slug(F.col("site"), maxlen))


def site_filter(files: DataFrame, wanted: str) -> DataFrame:
    """Rows whose site name contains the text, in any case."""
    return files.where(F.lower("site").contains(wanted.lower()))


def enrich(files: DataFrame, params: Params) -> DataFrame:
    """Typed rows -> rows ready for analysis: no system rows, all derived columns."""
    files = drop_system_files(drop_system_libraries(files))
    if "ext" not in files.columns:
        files = files.withColumn("ext", text.file_ext(F.col("file_name")))
    rel_path = text.relative_path(F.col("path"), F.col("site_url"))
    files = size_units(categorize(files.withColumn("_rel", rel_path)))
    if "checked_out" not in files.columns:
        files = files.withColumn("checked_out", F.lit(False))
    files = files.withColumn("depth", text.depth_of(F.col("_rel"))).drop("_rel")
    files = flag_post(files, params.migrated_at)
    return flag_inactive(files, params.migrated_at, params.inactive_years)
