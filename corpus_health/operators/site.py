"""Per-site sections, computed for all sites in one pass.

Input is a clean frame: `clean.clean` or `clean.enrich`. The key is `site_url`.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_health import constants as c
from corpus_health.functions import text
from corpus_health.functions.measures import gb, gb2, half_even, pct, width
from corpus_health.plans.cells import SITE, by_site, cells, known_in, of_dim
from corpus_health.plans.skew import top_k


def site_profile(files: DataFrame) -> DataFrame:
    """Size, people, depth and activity of each site."""
    parts = cells(files.where(F.col(SITE).isNotNull()), [SITE], ["library", "modified_by"])
    return profile_of(parts, "library")


def profile_of(parts: DataFrame, dim: str) -> DataFrame:
    """Site profile from cells; `dim` is any one dimension, which covers every row once."""
    once = lambda name: F.sum(of_dim(dim, name))
    return parts.groupBy(SITE).agg(
        once("n").alias("files"),
        once("bytes").alias("bytes"),
        gb(once("bytes")).alias("gb"),
        F.count_if(known_in("library")).alias("libraries"),
        F.count_if(known_in("modified_by")).alias("users"),
        F.max("depth_max").alias("depth_max"),
        half_even(once("depth_sum") / once("n"), 1).alias("depth_mean"),
        F.min("first").alias("first_modified"),
        F.max("last").alias("last_modified"),
        once("post").alias("post"),
        pct(once("post"), once("n")).alias("pct_post"),
        once("inactive").alias("inactive"),
        once("checked_out").alias("checked_out"),
    )


def site_status(profile: DataFrame) -> DataFrame:
    post, files = F.col("post"), F.col("files")
    return profile.withColumn(
        "status",
        F.when(post == 0, c.STATUS_ARCHIVE)
        .when(post * 100 >= files * c.ACTIVE_PCT, c.STATUS_ACTIVE)
        .otherwise(c.STATUS_LOW),
    )


def site_categories(files: DataFrame) -> DataFrame:
    """Categories of each site by volume."""
    return categories_of(by_site(files, "category", ["bytes"]))


def categories_of(found: DataFrame) -> DataFrame:
    return found.select(
        SITE,
        "category",
        "files",
        gb("bytes").alias("gb"),
        pct("files", "site_n").alias("pct_files"),
        pct("bytes", "site_bytes").alias("pct_gb"),
        "rank",
    )


def dominant_category(files: DataFrame) -> DataFrame:
    """Largest category of each site, with its share of the files."""
    return by_site(files, "category", ["bytes"], k=1).select(
        SITE, "category", pct("files", "site_n").alias("pct_files")
    )


def site_extensions(files: DataFrame, k: int = 15) -> DataFrame:
    """Largest extensions of each site; files without extension have no line."""
    return extensions_of(by_site(_with_known_ext(files), "ext", ["bytes"], k))


def extensions_of(found: DataFrame) -> DataFrame:
    return found.select(
        SITE,
        "ext",
        "files",
        gb("bytes").alias("gb"),
        pct("bytes", "site_bytes").alias("pct_gb"),
        text.special_format(F.col("ext")).isNotNull().alias("special"),
        "rank",
    )


def site_special_formats(files: DataFrame) -> DataFrame:
    """Formats of each site that need a decision, with the alert they raise."""
    special = F.when(F.col("ext").isin(list(c.SPECIAL_FORMATS)), F.col("ext"))
    found = by_site(files.withColumn("ext", special), "ext")
    known = text.special_format(F.col("ext"))
    return found.select(
        SITE,
        "ext",
        known["label"].alias("label"),
        known["note"].alias("note"),
        "files",
        gb("bytes").alias("gb"),
        pct("bytes", "site_bytes").alias("pct_gb"),
        format_alert(F.col("ext"), gb("bytes")).alias("alert"),
    )


def format_alert(ext: Column, gigabytes: Column) -> Column:
    return (
        F.when(ext.isin(c.ATTENTION_FORMATS), c.ATTENTION_ALERT)
        .when(ext.isin(c.VIDEO_FORMATS), c.VIDEO_ALERT)
        .when(ext.isin(c.ARCHIVE_FORMATS) & (gigabytes > c.ARCHIVE_ALERT_GB), c.ARCHIVE_ALERT)
        .otherwise(c.REVIEW_ALERT)
    )


LISTING = [
    "path", "file_name", "folder", "size_bytes", "size_mb", "modified_ts", "modified_by"
]


def _listing(files: DataFrame) -> DataFrame:
    return files.where(F.col(SITE).isNotNull()).select(SITE, *LISTING)


def large_files(files: DataFrame, mb: int = 100, k: int = 20) -> DataFrame:
    """Largest files of each site above the limit, and whether they can be migrated."""
    big = _listing(files.where(F.col("size_bytes") > mb * 1024 * 1024))
    order = [F.desc("size_bytes"), *[F.col(name) for name in LISTING]]
    return top_k(big, [SITE], order, k, hot=True).withColumn(
        "over_limit", F.col("size_bytes") > c.MIGRATION_LIMIT_BYTES
    )


def is_oversize_archive() -> Column:
    return (F.col("ext") == "zip") & (F.col("size_bytes") > c.MIGRATION_LIMIT_BYTES)


def oversize_archives(files: DataFrame) -> DataFrame:
    """Every zip too large to migrate."""
    return _listing(files.where(is_oversize_archive())).orderBy(SITE, F.desc("size_bytes"), "path")


def duplicates(files: DataFrame) -> DataFrame:
    """Groups of equal name and size within a site, and the bytes of their extra copies."""
    sized = files.where((F.col("size_bytes") > 0) & F.col(SITE).isNotNull())
    groups = sized.where("file_name IS NOT NULL").groupBy(SITE, "file_name", "size_bytes")
    return duplicates_of(groups.agg(F.count("*").alias("copies")))


def duplicates_of(groups: DataFrame) -> DataFrame:
    extra = F.col("size_bytes") * (F.col("copies") - 1)
    return groups.where("copies > 1").withColumn("extra_bytes", extra)


def duplicate_totals(dups: DataFrame) -> DataFrame:
    return dups.groupBy(SITE).agg(
        F.sum(F.col("copies") - 1).alias("extra_files"),
        F.count("*").alias("n_groups"),
        F.sum("extra_bytes").alias("extra_bytes"),
        gb(F.sum("extra_bytes")).alias("extra_gb"),
    )


def top_duplicates(dups: DataFrame, k: int = 15) -> DataFrame:
    """Groups that waste most, for sites where duplicates matter at all."""
    totals = duplicate_totals(dups)
    worth = totals.where(F.col("extra_gb") > c.DUPLICATE_REPORT_GB).select(SITE)
    order = [F.desc("extra_bytes"), F.asc("file_name"), F.asc("size_bytes")]
    return top_k(dups, [SITE], order, k).join(worth, SITE, "left_semi")


def activity_by_year(files: DataFrame, migrated_at: datetime) -> DataFrame:
    """Files by year of last change, with the width against the busiest year."""
    dated = files.withColumn("year", F.year("modified_ts"))
    return years_of(by_site(dated, "year"), migrated_at)


def years_of(found: DataFrame, migrated_at: datetime) -> DataFrame:
    return found.select(
        SITE,
        "year",
        "files",
        gb("bytes").alias("gb"),
        width("files", "max_files").alias("width"),
        (F.col("year") >= migrated_at.year).alias("is_post"),
    )


def site_users(files: DataFrame, k: int = 20) -> DataFrame:
    """People who changed most files of each site."""
    return users_of(by_site(files, "modified_by", ["files"], k))


def users_of(found: DataFrame) -> DataFrame:
    return found.select(
        SITE,
        "modified_by",
        "files",
        pct("files", "site_n").alias("pct_files"),
        gb2("bytes").alias("gb"),
        "post",
        F.col("last").alias("last_modified"),
        "rank",
    )


def real_owner(files: DataFrame) -> DataFrame:
    """Who changed most files: the owner in practice."""
    return site_users(files, k=1).select(SITE, F.col("modified_by").alias("real_owner"), "files")


def site_folders(files: DataFrame, k: int = 20) -> DataFrame:
    """Largest top folders of each site."""
    placed = files.withColumn("top_folder", text.top_folder(F.col("folder")))
    return folders_of(by_site(placed, "top_folder", ["bytes"], k))


def folders_of(found: DataFrame) -> DataFrame:
    return found.select(
        SITE,
        "top_folder",
        "files",
        gb("bytes").alias("gb"),
        pct("files", "site_n").alias("pct_files"),
        width("bytes", "max_bytes").alias("width"),
        "rank",
    )


def site_checked_out(files: DataFrame) -> DataFrame:
    """Every file somebody holds, in its site."""
    return _listing(files.where("checked_out"))


def checked_out_counts(files: DataFrame) -> DataFrame:
    held = files.where(F.col("checked_out") & F.col(SITE).isNotNull())
    return held.groupBy(SITE).agg(F.count("*").alias("checked_out"))


def site_recent_post(files: DataFrame, k: int = 50) -> DataFrame:
    """Newest files changed after the migration, per site."""
    rows = _listing(files.where("is_post"))
    order = [F.desc("modified_ts"), *[F.col(name) for name in LISTING]]
    return top_k(rows, [SITE], order, k, hot=True)


def format_counts(files: DataFrame) -> DataFrame:
    """Per site, the counts that lead to a decision."""
    ext = F.col("ext")
    video_bytes = F.sum(F.when(ext.isin(c.VIDEO_FORMATS), F.col("size_bytes")))
    return files.where(F.col(SITE).isNotNull()).groupBy(SITE).agg(
        F.count_if(is_oversize_archive()).alias("n_archives"),
        F.count_if(ext == "heic").alias("n_heic"),
        F.count_if(ext == "xlsm").alias("n_xlsm"),
        F.count_if(ext == "xlsb").alias("n_xlsb"),
        F.count_if(ext.isin(c.VIDEO_FORMATS)).alias("n_video"),
        video_bytes.alias("video_bytes"),
    )


def decisions(files: DataFrame, dups: DataFrame | None = None) -> DataFrame:
    """Open decisions of each site, numbered without gaps; one line says when there is none."""
    totals = duplicate_totals(duplicates(files) if dups is None else dups)
    return decisions_of(format_counts(files), totals)


DECISION_COUNTS = ["n_archives", "n_heic", "n_xlsm", "n_xlsb", "n_video", "video_bytes"]


def decisions_of(counts: DataFrame, dup_totals: DataFrame) -> DataFrame:
    facts = counts.join(dup_totals, SITE, "left")
    listed = decision_list(F.col("extra_files"), F.col("extra_gb"))
    return facts.select(SITE, F.explode(listed).alias("d")).select(SITE, "d.*")


def decision_list(n_dups: Column, dup_gb: Column) -> Column:
    """The decisions that hold, in order and numbered; beside DECISION_COUNTS."""
    macros = F.when(F.col("n_xlsm") > 0, F.lit("xlsm")).otherwise(F.lit("xlsb"))
    n_macros = F.when(F.col("n_xlsm") > 0, F.col("n_xlsm")).otherwise(F.col("n_xlsb"))
    found = F.array_compact(
        F.array(
            _decision(F.col("n_archives") > 0, "red", "zip", "n_archives", None, c.TAG_ARCHIVES),
            _decision(F.col("n_heic") > 0, "gold", "heic", "n_heic", None, c.TAG_IMAGES),
            _decision(n_macros > 0, "gold", macros, n_macros, None, c.TAG_MACROS),
            _decision(
                F.col("n_video") > 0, "orange", "video", "n_video", gb("video_bytes"), c.TAG_VIDEO
            ),
            _decision(
                dup_gb > c.DUPLICATE_DECISION_GB,
                "gold", "duplicates", n_dups, dup_gb, c.TAG_DUPLICATES,
            ),
        )
    )
    none = _decision(F.lit(True), "green", "none", F.lit(0), None, c.TAG_READY)
    listed = F.when(F.size(found) > 0, found).otherwise(F.array(none))
    return F.transform(
        listed, lambda d, i: F.struct((i + 1).alias("num"), *[d[f].alias(f) for f in DECISION_FIELDS])
    )


DECISION_FIELDS = ["colour", "subject", "n", "gb", "tag"]


def _decision(holds, colour: str, subject, n, gigabytes, tag: str) -> Column:
    subject = F.lit(subject) if isinstance(subject, str) else subject
    n = F.col(n) if isinstance(n, str) else n
    gigabytes = F.lit(None) if gigabytes is None else gigabytes
    return F.when(
        holds,
        F.struct(
            F.lit(colour).alias("colour"),
            subject.alias("subject"),
            n.cast("bigint").alias("n"),
            gigabytes.cast("double").alias("gb"),
            F.lit(tag).alias("tag"),
        ),
    )


def _with_known_ext(files: DataFrame) -> DataFrame:
    return files.withColumn("ext", F.nullif(F.col("ext"), F.lit("")))
