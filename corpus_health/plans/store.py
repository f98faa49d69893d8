"""One stored table of cells that reports and breakdowns are answered from.

A pass over the files adds them up by each dimension of each site. The cells are far
fewer than the files; whatever is asked of them later reads no file. `land` writes them,
and all other functions take the table that it returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_health import constants as c
from corpus_health.functions import text
from corpus_health.operators import site, tenant
from corpus_health.params import Params
from corpus_health.plans import cells
from corpus_health.plans.cells import SITE
from corpus_health.sources.shared import work_dir

#: Dimensions of a site; `whole` is the site itself, `copies` the groups of equal name and size.
DIMS = ["category", "special", "year", "modified_by", "top_folder", "ext", "library"]
WHOLE, COPIES = "whole", "copies"
COPY = ["file_name", "copy_size"]
#: Columns of a file that cells are made of.
USED = [
    "site", SITE, "library", "folder", "file_name", "ext", "category", "size_bytes", "modified_ts", "modified_by",
    "is_post", "is_inactive", "checked_out", "depth",
]


def land(files: DataFrame, params: Params, path: str | None = None) -> DataFrame:
    """Write the cells of a clean frame, to a folder of this run unless one is given, and read them back."""
    table = summed(files, params)
    path = path or work_dir(files.sparkSession, "cells")
    table.write.partitionBy("dim").parquet(path)
    return files.sparkSession.read.schema(table.schema).parquet(path)


def summed(files: DataFrame, params: Params) -> DataFrame:
    """The cells from one scan; files without site have cells too, for totals.

    Rows of a site are brought together first, as narrow as they are: a task that has a few
    rows of every site would hand on more cells than rows. Spark splits a site that is too
    large for a task, and the cells of its parts are added up. Copies have a cell only where
    there are several, so that single files have none.
    """
    used = [n for n in USED if n in files.columns]
    files = files.select(*used).hint("rebalance", SITE)
    ext = F.nullif(F.col("ext"), F.lit(""))
    copied = (F.col("size_bytes") > 0) & F.col("file_name").isNotNull() & F.col(SITE).isNotNull()
    rows = files.withColumns(
        {
            "ext": ext,
            "special": F.when(ext.isin(list(c.SPECIAL_FORMATS)), ext),
            "year": F.year("modified_ts"),
            "top_folder": text.top_folder(F.col("folder")),
            "copy_size": F.when(copied, F.col("size_bytes")),
        }
    )
    over = F.count_if(F.col("size_bytes") > c.MIGRATION_LIMIT_BYTES).alias("over")
    large = F.count_if(F.col("size_bytes") > params.large_mb * 1024 * 1024).alias("large")
    sets = [["site", SITE, d] for d in DIMS] + [["site", SITE], [SITE, *COPY]]
    dim = F.coalesce(
        *[F.when(F.grouping(d) == 0, F.lit(d)) for d in DIMS],
        F.when(F.grouping("copy_size") == 0, F.lit(COPIES)),
        F.lit(WHOLE),
    )
    aggs = [value.alias(name) for name, value in cells.measures(files).items()]
    grouped = rows.groupingSets([[F.col(n) for n in names] for names in sets], "site", SITE, *DIMS, *COPY)
    found = grouped.agg(dim.alias("dim"), over, large, *aggs)
    return found.where((F.col("dim") != COPIES) | (F.col("copy_size").isNotNull() & (F.col("n") > 1)))


def breakdowns(store: DataFrame) -> DataFrame:
    """One cell for each known value of each dimension in a site, and one, of `dim` whole, for the site."""
    parts = store.where((F.col("dim") != COPIES) & F.col(SITE).isNotNull())
    known = F.coalesce(*[F.col(d).cast("string") for d in DIMS]).isNotNull()
    return cells.regroup(parts, SITE, "dim", *DIMS).where(known | (F.col("dim") == WHOLE))


def duplicates(store: DataFrame) -> DataFrame:
    groups = store.where(F.col("dim") == COPIES)
    return site.duplicates_of(groups.select(SITE, "file_name", F.col("copy_size").alias("size_bytes"), F.col("n").alias("copies")))


def corpus_totals(store: DataFrame) -> DataFrame:
    parts = store.where(F.col("dim").isin(WHOLE, "modified_by"))
    dim = F.when(F.col("dim") == WHOLE, F.lit("site")).otherwise(F.col("dim")).alias("dim")
    name = F.when(F.col("dim") == WHOLE, F.col("site")).alias("site")
    return tenant.totals_of(cells.regroup(parts, dim, name, "modified_by"))


def site_summary(store: DataFrame) -> DataFrame:
    named = store.where("site IS NOT NULL AND site_url IS NOT NULL")
    return tenant.summary_of(named.where(F.col("dim").isin("category", "modified_by", "library")))


def site_profile(store: DataFrame) -> DataFrame:
    parts = store.where(F.col("dim").isin("library", "modified_by") & F.col(SITE).isNotNull())
    return site.profile_of(cells.regroup(parts, SITE, "dim", "library", "modified_by"), "library")


def site_categories(store: DataFrame) -> DataFrame:
    return site.categories_of(_ranked(store, "category", "bytes"))


def site_extensions(store: DataFrame, k: int = 15) -> DataFrame:
    return site.extensions_of(_ranked(store, "ext", "bytes", k=k))


def activity_by_year(store: DataFrame, params: Params) -> DataFrame:
    return site.years_of(_ranked(store, "year"), params.migrated_at)


def site_users(store: DataFrame, k: int = 20) -> DataFrame:
    return site.users_of(_ranked(store, "modified_by", "files", k=k))


def site_folders(store: DataFrame, k: int = 20) -> DataFrame:
    return site.folders_of(_ranked(store, "top_folder", "bytes", k=k))


def _ranked(store: DataFrame, dim: str, *order: str, k: int | None = None) -> DataFrame:
    parts = store.where(F.col("dim").isin(dim, WHOLE) & F.col(SITE).isNotNull())
    whole = F.when(F.col("dim") == WHOLE, 1).otherwise(0).alias("_total")
    return cells.ranked_by_site(cells.regroup(parts, SITE, dim, whole), dim, order, k)
