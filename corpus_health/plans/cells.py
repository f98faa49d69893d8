"""Several groupings of the file rows from one scan and one shuffle.

GROUPING SETS reads the rows once, combines them on the map side for every
wanted grouping, and shuffles only the combined cells. Distinct counts become
plain counts of cells, and totals travel as cells of their own, so nothing
needs a second pass over the files or a join back to them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SITE = "site_url"


def measures(files: DataFrame) -> dict[str, Column]:
    """What a cell knows about its rows; Spark drops what a query does not read.

    Surveys of some ages lack the check-out mark and the depth: nobody holds a
    file then, and the depth is 0.
    """
    held = F.col("checked_out") if "checked_out" in files.columns else F.lit(False)
    depth = F.col("depth") if "depth" in files.columns else F.lit(0)
    known = {
        "n": F.count("*"),
        "files": F.count("file_name"),
        "bytes": F.sum("size_bytes"),
        "post": F.count_if("is_post"),
        "inactive": F.count_if("is_inactive"),
        "first": F.min("modified_ts"),
        "last": F.max("modified_ts"),
        "checked_out": F.count_if(held),
        "depth_max": F.max(depth),
        "depth_sum": F.sum(depth),
    }
    return known


MEASURES = [
    "n", "files", "bytes", "post", "inactive", "first", "last", "checked_out", "depth_max", "depth_sum", "over", "large",
]


#: How cells of one kind become one cell; what is not named here is added up.
EXTREMES = {"first": F.min, "last": F.max, "depth_max": F.max}


def regroup(parts: DataFrame, *keys: str | Column) -> DataFrame:
    """Fewer keys: the cells that have them in common as one."""
    names = [n for n in parts.columns if n in MEASURES]
    return parts.groupBy(*keys).agg(*[EXTREMES.get(n, F.sum)(n).alias(n) for n in names])


def cells(files: DataFrame, keys: Sequence[str], dims: Sequence[str]) -> DataFrame:
    """One cell per (keys, dimension value), for each dimension by itself.

    `dim` names the dimension a cell belongs to.
    """
    sets = [[F.col(c) for c in (*keys, dim)] for dim in dims]
    aggs = [value.alias(name) for name, value in measures(files).items()]
    dim = F.coalesce(*[F.when(F.grouping(d) == 0, F.lit(d)) for d in dims])
    return files.groupingSets(sets, *keys, *dims).agg(dim.alias("dim"), *aggs)


def of_dim(dim: str, value: Column | str) -> Column:
    """A cell value that counts only within its own dimension."""
    return F.when(F.col("dim") == dim, F.col(value) if isinstance(value, str) else value)


def known_in(dim: str) -> Column:
    """A cell of the dimension with a known value: counting them counts distinct values."""
    return (F.col("dim") == dim) & F.col(dim).isNotNull()


def by_site(
    files: DataFrame, dim: str, order: Sequence[str] = (), k: int | None = None
) -> DataFrame:
    """Cells of one dimension per site, ranked, with the totals of the site.

    Rows without a value count in the site totals (`site_n`, `site_bytes`) and
    have no cell. With `k`, each site keeps its first k cells: the total sorts
    before them, so trimming to k + 1 rows keeps it and no task ever holds all
    cells of a site. Leave `k` out only for dimensions with few values.
    """
    aggs = [value.alias(name) for name, value in measures(files).items()]
    sets = [[F.col(SITE), F.col(dim)], [F.col(SITE)]]
    rows = files.where(F.col(SITE).isNotNull()).groupingSets(sets, SITE, dim)
    return ranked_by_site(rows.agg(F.grouping(dim).alias("_total"), *aggs), dim, order, k)


def ranked_by_site(
    rows: DataFrame, dim: str, order: Sequence[str] = (), k: int | None = None
) -> DataFrame:
    """The same from cells of the dimension per site and one cell per site with `_total` 1."""
    rows = rows.where((F.col("_total") == 1) | F.col(dim).isNotNull())
    ranked = Window.partitionBy(SITE).orderBy(
        F.desc("_total"), *[F.desc(name) for name in order], F.asc(dim)
    )
    rows = rows.withColumn("_n", F.row_number().over(ranked))
    if k is not None:
        rows = rows.where(F.col("_n") <= k + 1)
    site = Window.partitionBy(SITE)
    is_total = F.col("_total") == 1
    return (
        rows.withColumns(
            {
                "site_n": F.max(F.when(is_total, F.col("n"))).over(site),
                "site_bytes": F.max(F.when(is_total, F.col("bytes"))).over(site),
                "max_files": F.max(F.when(~is_total, F.col("files"))).over(site),
                "max_bytes": F.max(F.when(~is_total, F.col("bytes"))).over(site),
                "rank": F.col("_n") - 1,
            }
        )
        .where(~is_total)
        .drop("_n", "_total")
    )
