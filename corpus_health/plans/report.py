"""One nested row per site with every section of its report.

The breakdowns by category, extension, special format, year, user and folder, and the
duplicates, come from stored cells (`plans.store`): one scan of the files. The lists of
single files come from a second one. Groups are trimmed to what a report shows before
they meet, so a site never arrives whole in one task, and the arrays of a report stay
short however large its site is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_health import constants as c
from corpus_health.functions import text
from corpus_health.functions.measures import gb, gb2, half_even, pct, width
from corpus_health.operators import site
from corpus_health.params import Params
from corpus_health.plans import store
from corpus_health.plans.cells import SITE
from corpus_health.plans.skew import top_k

#: Measures of the whole site that a report uses.
SHOWN = ["n", "bytes", "post", "inactive", "first", "last", "checked_out", "depth_max", "depth_sum"]
LIMITED = ["modified_by", "top_folder", "ext"]  # shown up to a number of rows, with their total
UNLIMITED = ["category", "special", "year"]  # few values; libraries are only counted


def site_report(
    files: DataFrame, params: Params, duplicates: DataFrame | None = None, stored: DataFrame | None = None
) -> DataFrame:
    """Profile, status and all limited sections of every site.

    `params` says how many rows each limited list has; its total stands beside it
    (`users`, `n_folders`, `n_extensions`, `n_duplicates`, `n_large`, `post`).
    Unlimited lists (oversize archives, checked-out files) are counted here and
    written as tables of their own. Pass what `store.land` or `site.duplicates` gave
    where it is at hand; else the cells are landed here.
    """
    stored = store.land(files, params) if stored is None else stored
    files = files.where(F.col(SITE).isNotNull())
    dups = store.duplicates(stored) if duplicates is None else duplicates
    dup_totals = site.duplicate_totals(dups)
    found = store.breakdowns(stored)
    report = _sections(found, params).join(_totals(found), SITE, "left")
    groups = dup_totals.withColumn("n_duplicates", F.col("n_groups"))
    report = report.join(
        groups.select(SITE, "extra_files", "extra_bytes", "extra_gb", "n_duplicates"), SITE, "left"
    )
    report = report.withColumn("n_duplicates", F.coalesce("n_duplicates", F.lit(0).cast("bigint")))
    top = _as_array(site.top_duplicates(dups, params.report_duplicates), "top_duplicates")
    for rows in (top, _listed_files(files, params)):
        report = report.join(rows, SITE, "left")
    for name in ("top_duplicates", "recent_post", "large_files"):
        report = report.withColumn(name, F.coalesce(name, F.array()))
    decided = site.decision_list(F.col("extra_files"), F.col("extra_gb"))
    report = report.withColumn("decisions", decided).drop(*site.DECISION_COUNTS)
    return site.site_status(report)


def _listed_files(files: DataFrame, params: Params) -> DataFrame:
    """The newest changed and the largest files of each site, as `site` has them, as arrays from one pass."""
    large = F.col("size_bytes") > params.large_mb * 1024 * 1024
    kinds = F.array_compact(F.array(F.when(F.col("is_post"), "post"), F.when(large, "large")))
    rows = files.where(F.col("is_post") | large).select(SITE, *site.LISTING, F.explode(kinds).alias("kind"))
    first = [
        F.when(F.col("kind") == "large", F.col("size_bytes")).desc(),
        F.when(F.col("kind") == "post", F.col("modified_ts")).desc(),
    ]
    order = [*first, *[F.col(name) for name in site.LISTING]]
    most = max(params.report_post, params.report_large)
    ranked = top_k(rows, [SITE, "kind"], order, most, hot=True)
    kept = F.when(F.col("kind") == "post", params.report_post).otherwise(params.report_large)
    over = (F.col("size_bytes") > c.MIGRATION_LIMIT_BYTES).alias("over_limit")
    of_kind = lambda kind, *more: F.array_sort(
        F.collect_list(F.when(F.col("kind") == kind, F.struct("rank", *site.LISTING, *more)))
    )
    return ranked.where(F.col("rank") <= kept).groupBy(SITE).agg(
        of_kind("post").alias("recent_post"), of_kind("large", over).alias("large_files")
    )


def _totals(found: DataFrame) -> DataFrame:
    """How many values each dimension has in a site, and its large files."""
    values = lambda dim: F.count_if(F.col("dim") == dim)
    return found.groupBy(SITE).agg(
        values("library").alias("libraries"),
        values("modified_by").alias("users"),
        values("top_folder").alias("n_folders"),
        values("ext").alias("n_extensions"),
        F.max(F.when(F.col("dim") == store.WHOLE, F.col("large"))).alias("n_large"),
    )


def _sections(found: DataFrame, params: Params) -> DataFrame:
    """Totals of each site and its breakdowns as arrays."""
    keep = {
        "modified_by": params.report_users,
        "top_folder": params.report_folders,
        "ext": params.report_exts,
        "library": 0,
    }
    # values of an unlimited dimension are groups of their own, so all rank first
    by_files = F.when(F.col("dim") == "modified_by", F.col("files")).otherwise(F.col("bytes"))
    group = Window.partitionBy(SITE, "dim", *UNLIMITED).orderBy(F.desc(by_files), *LIMITED)
    limit = F.lit(None)
    for name, k in keep.items():
        limit = F.when(F.col("dim") == name, k).otherwise(limit)
    trimmed = (
        found.where("dim != 'library'")
        .withColumn("rank", F.row_number().over(group))
        .where(F.col("rank") <= max(1, *keep.values()))
        .where(F.coalesce(F.col("rank") <= limit, F.lit(True)))
    )

    in_site = lambda name: F.max(F.when(F.col("dim") == store.WHOLE, F.col(name)))
    special = lambda exts, value: F.sum(F.when(F.col("special").isin(exts), F.col(value)))
    array = lambda name, *fields: F.array_sort(
        F.collect_list(F.when(F.col("dim") == name, F.struct(*fields)))
    ).alias(f"_{name}")
    largest = -F.col("bytes")
    sites = trimmed.groupBy(SITE).agg(
        *[in_site(name).alias(name) for name in SHOWN],
        special(["zip"], "over").alias("n_archives"),
        special(["heic"], "n").alias("n_heic"),
        special(["xlsm"], "n").alias("n_xlsm"),
        special(["xlsb"], "n").alias("n_xlsb"),
        special(c.VIDEO_FORMATS, "n").alias("n_video"),
        special(c.VIDEO_FORMATS, "bytes").alias("video_bytes"),
        array("category", largest.alias("_order"), "category", "files", "bytes"),
        array("ext", "rank", "ext", "files", "bytes"),
        array("special", "special", "files", "bytes"),
        array("year", "year", "files", "bytes"),
        array("modified_by", "rank", "modified_by", "files", "bytes", "post", "last"),
        array("top_folder", "rank", "top_folder", "files", "bytes"),
    )
    return _shown(sites, params)


def _shown(sites: DataFrame, params: Params) -> DataFrame:
    """Sums -> the figures a report shows, with the shares of the site."""
    n, all_bytes = F.col("n"), F.col("bytes")
    most = lambda name, field: F.array_max(F.transform(f"_{name}", lambda x: x[field]))

    def rows(name: str, **fields) -> Column:
        return F.transform(
            f"_{name}", lambda x: F.struct(*[f(x).alias(field) for field, f in fields.items()])
        )

    files = lambda x: x["files"]
    size = lambda x: gb(x["bytes"])
    share_files = lambda x: pct(x["files"], n)
    share_bytes = lambda x: pct(x["bytes"], all_bytes)
    rank = lambda x: x["rank"]
    note = lambda field: lambda x: text.special_format(x["special"])[field]
    zero = F.lit(0).cast("bigint")
    counts = {name: F.coalesce(name, zero) for name in site.DECISION_COUNTS if name != "video_bytes"}
    return sites.withColumns(counts).select(
        SITE,
        n.alias("files"),
        all_bytes.alias("bytes"),
        gb(all_bytes).alias("gb"),
        "depth_max",
        half_even(F.col("depth_sum") / n, 1).alias("depth_mean"),
        F.col("first").alias("first_modified"),
        F.col("last").alias("last_modified"),
        "post",
        pct("post", n).alias("pct_post"),
        "inactive",
        "checked_out",
        F.col("n_archives").alias("oversize_archives"),
        *site.DECISION_COUNTS,
        rows(
            "category",
            category=lambda x: x["category"], files=files, gb=size,
            pct_files=share_files, pct_gb=share_bytes,
        ).alias("categories"),
        rows(
            "ext",
            rank=rank, ext=lambda x: x["ext"], files=files, gb=size, pct_gb=share_bytes,
            special=lambda x: text.special_format(x["ext"]).isNotNull(),
        ).alias("extensions"),
        rows(
            "special",
            ext=lambda x: x["special"], label=note("label"), note=note("note"),
            files=files, gb=size, pct_gb=share_bytes,
            alert=lambda x: site.format_alert(x["special"], gb(x["bytes"])),
        ).alias("special_formats"),
        rows(
            "year",
            year=lambda x: x["year"], files=files, gb=size,
            width=lambda x: width(x["files"], most("year", "files")),
            is_post=lambda x: x["year"] >= params.migrated_at.year,
        ).alias("years"),
        rows(
            "modified_by",
            rank=rank, modified_by=lambda x: x["modified_by"], files=files,
            pct_files=share_files, gb=lambda x: gb2(x["bytes"]),
            post=lambda x: x["post"], last_modified=lambda x: x["last"],
        ).alias("top_users"),
        rows(
            "top_folder",
            rank=rank, top_folder=lambda x: x["top_folder"], files=files, gb=size,
            pct_files=share_files,
            width=lambda x: width(x["bytes"], most("top_folder", "bytes")),
        ).alias("folders"),
    )


def _as_array(section: DataFrame, name: str) -> DataFrame:
    """The rows of a limited section as one array per site, in order of rank."""
    fields = [field for field in section.columns if field not in (SITE, "rank")]
    row = F.struct("rank", *fields)
    return section.groupBy(SITE).agg(F.array_sort(F.collect_list(row)).alias(name))
