"""Analysis of the whole estate and the one-row-per-site summary.

Input is a clean frame: `clean.clean` or `clean.enrich`. Every operator
aggregates file rows on the map side first, so a site that holds a large part
of all rows costs its tasks no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_health import constants as c
from corpus_health.functions.measures import big_sum, gb, gb2, pct, total, width
from corpus_health.plans.cells import cells, known_in, of_dim
from corpus_health.plans.skew import top_k_overall
from corpus_health.sources.shared import landed


def corpus_totals(files: DataFrame) -> DataFrame:
    """One row: size, activity and people of the estate."""
    return totals_of(cells(files, [], ["site", "modified_by"]))


def totals_of(parts: DataFrame) -> DataFrame:
    """The totals from the cells of the estate by site name and by person."""
    n, post = total(of_dim("site", "n")), total(of_dim("site", "post"))
    return parts.agg(
        n.alias("files"),
        F.coalesce(gb(big_sum(of_dim("site", "bytes"))), F.lit(0.0)).alias("gb"),
        F.count_if(known_in("site")).alias("sites"),
        post.alias("post"),
        pct(post, n).alias("pct_post"),
        total(of_dim("site", "inactive")).alias("inactive"),
        total(of_dim("site", "checked_out")).alias("checked_out"),
        F.count_if(known_in("modified_by")).alias("users"),
    )


def site_summary(files: DataFrame) -> DataFrame:
    """One row per site: size, activity, people, main category, recommendation.

    Rows of a site are brought together first: a task that has a few rows of every site would
    hold and hand on more cells than rows. Spark splits a site that is too large for a task.
    """
    named = files.where("site IS NOT NULL AND site_url IS NOT NULL").hint("rebalance", "site_url")
    return summary_of(cells(named, ["site", "site_url"], ["category", "modified_by", "library"]))


def summary_of(parts: DataFrame) -> DataFrame:
    """The summary from the cells of each site by category, person and library."""
    return (
        parts.groupBy("site", "site_url")
        .agg(
            F.sum(of_dim("category", "n")).alias("files"),
            F.sum(of_dim("category", "bytes")).alias("bytes"),
            F.sum(of_dim("category", "post")).alias("post"),
            F.max("last").alias("last_modified"),
            F.count_if(known_in("modified_by")).alias("users"),
            F.count_if(known_in("library")).alias("libraries"),
            _most_frequent().alias("top_category"),
        )
        .withColumns({"gb": gb("bytes"), "pct_post": pct("post", "files")})
        .withColumn("recommendation", recommendation(F.col("post"), F.col("files")))
    )


def top_category(files: DataFrame) -> DataFrame:
    """Most frequent category of each site; the first by name among equals."""
    named = files.where("site IS NOT NULL AND site_url IS NOT NULL")
    counts = named.groupBy("site", "site_url", "category").agg(F.count("*").alias("n"))
    return counts.groupBy("site", "site_url").agg(_most_frequent().alias("top_category"))


def _most_frequent() -> Column:
    size = F.struct(-F.col("n"), F.col("category"))
    return F.min_by("category", F.when(F.col("category").isNotNull(), size))


def recommendation(post: Column, files: Column) -> Column:
    """What to do with a site, on whole numbers so that 30 % is exact."""
    return (
        F.when(post == 0, F.lit(c.ARCHIVE))
        .when(post * 100 >= files * c.ACTIVE_PCT, F.lit(c.ACTIVE))
        .otherwise(F.lit(c.REVIEW))
    )


def recommend(summary: DataFrame) -> DataFrame:
    return summary.withColumn("recommendation", recommendation(F.col("post"), F.col("files")))


def recommendation_counts(summary: DataFrame) -> DataFrame:
    """Sites and volume per recommendation; `Archivar` is what can be recovered."""
    return summary.groupBy("recommendation").agg(
        F.count("*").alias("n_sites"), gb(big_sum("bytes")).alias("gb")
    )


def archive_candidates(summary: DataFrame) -> DataFrame:
    """Sites to archive by volume, with their width against the largest.

    The largest must be known before the first row, so the sites, one row each, are landed:
    what `summary` is made of is read once.
    """
    sites = landed(summary.where(F.col("recommendation") == c.ARCHIVE), "archive-candidates")
    largest = sites.select(F.max("bytes")).scalar()
    return sites.withColumn("width", width(F.col("bytes"), largest)).orderBy(
        F.desc("bytes"), "site_url"
    )


def category_stats(files: DataFrame) -> DataFrame:
    """Files and volume per category with their share of the estate.

    A row without category counts in the totals and has no line of its own.
    """
    # per site first: bytes of one site fit a bigint, bytes of a category may not
    by_site = files.groupBy("category", "site_url").agg(
        F.count("*").alias("n"),
        F.count("file_name").alias("files"),
        F.sum("size_bytes").alias("bytes"),
    )
    # totals of the estate as one more row of the grouping; there are as many rows as categories
    whole = F.grouping("category") == 1
    sums = by_site.groupingSets([[F.col("category")], []], "category").agg(
        whole.alias("whole"), F.sum("n").alias("n"), F.sum("files").alias("files"), big_sum("bytes").alias("bytes")
    )
    every = Window.partitionBy()
    all_files = F.max(F.when(F.col("whole"), F.col("n"))).over(every)
    all_bytes = F.max(F.when(F.col("whole"), F.col("bytes"))).over(every)
    return (
        sums.select(
            "category",
            "files",
            gb("bytes").alias("gb"),
            pct(F.col("files"), all_files).alias("pct_files"),
            pct(F.col("bytes"), all_bytes).alias("pct_gb"),
        )
        .where("category IS NOT NULL")
        .orderBy(F.desc("gb"), "category")
    )


def top_users(files: DataFrame, k: int = 30) -> DataFrame:
    """Users with most files; the number of sites needs no distinct over file rows."""
    by_site = files.groupBy("modified_by", "site").agg(
        F.count("file_name").alias("n"),
        F.sum("size_bytes").alias("bytes"),
        F.count_if("is_post").alias("post"),
        F.max("modified_ts").alias("last"),
    )
    users = (
        by_site.where("modified_by IS NOT NULL")
        .groupBy("modified_by")
        .agg(
            F.sum("n").alias("files"),
            gb2(big_sum("bytes")).alias("gb"),
            F.count("site").alias("sites"),
            F.sum("post").alias("post"),
            F.max("last").alias("last_modified"),
        )
    )
    return top_k_overall(users, [F.desc("files"), F.asc("modified_by")], k)


FILE_LISTING = [
    "site", "site_url", "path", "file_name", "folder", "category", "size_bytes", "size_mb",
    "modified_ts", "created_by", "modified_by",
]


def _listing(files: DataFrame) -> DataFrame:
    return files.select(*FILE_LISTING)


def _then_all(*first: Column) -> list[Column]:
    """A total order: the given columns, then every listed column."""
    return [*first, *[F.col(name) for name in FILE_LISTING]]


def post_sample(files: DataFrame, k: int = 300) -> DataFrame:
    """Files changed after the migration, by site and newest first; k overall."""
    rows = _listing(files.where("is_post"))
    return top_k_overall(rows, _then_all(F.asc("site"), F.desc("modified_ts")), k)


def inactive_files(files: DataFrame, k: int = 150) -> DataFrame:
    """Oldest inactive files, with the number of all inactive files on every row."""
    inactive = files.where("is_inactive")
    total = inactive.select(F.count("*")).scalar()
    oldest = top_k_overall(_listing(inactive), _then_all(F.asc("modified_ts")), k)
    return oldest.withColumn("total", total)


def checked_out_files(files: DataFrame) -> DataFrame:
    """Every file somebody holds, by site."""
    return _listing(files.where("checked_out")).orderBy("site", "path")


def target_matrix(summary: DataFrame) -> DataFrame:
    """Migration worksheet: what is known, and three columns to fill in."""
    blank = F.lit(None).cast("string")
    return summary.select(
        "site",
        "site_url",
        "gb",
        "files",
        "recommendation",
        blank.alias("target_hub"),
        blank.alias("subfolder"),
        blank.alias("responsible"),
    ).orderBy(F.desc("gb"), "site_url")


def activity_colour(summary: DataFrame) -> DataFrame:
    """Severity of a site by its share of recent files."""
    post, files = F.col("post"), F.col("files")
    return summary.withColumn(
        "severity",
        F.when(post * 100 >= files * c.ACTIVE_PCT, "ok").when(post == 0, "critical").otherwise("warning"),
    )
