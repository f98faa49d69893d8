"""Site metrics from cells that signed changes keep current."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_health.functions import text
from corpus_health.operators import clean, health, tenant
from corpus_health.params import Params
from corpus_health.plans.cells import of_dim

#: What a cell is of, and what tells the cells of that kind apart.
KINDS = {
    "category": ["site", "site_url", "category"],
    "modified_by": ["site", "site_url", "modified_by"],
    "library": ["site", "site_url", "library"],
    "modified_ts": ["site", "site_url", "modified_ts"],
    "copies": ["site_url", "copy_name", "copy_size", "copy_ext"],
    "folder": ["site_url", "folder", "stem"],
}
KEYS = list(dict.fromkeys(name for names in KINDS.values() for name in names))
SUMS = ["n", "bytes", "post", "doc", "xls", "docx", "xlsx", "unreadable"]


def cells(signed: DataFrame, params: Params) -> DataFrame:
    """Sums over rows with a `sign`: 1 for a file that came, -1 for one that went.

    The number of a cell's rows says whether anything of it is left, so distinct users
    and libraries, the last change, copies and converted documents can be taken back.
    """
    ready = clean.enrich(signed.where("site_url IS NOT NULL"), params).withColumns(
        {
            "copy_name": F.col("file_name"),
            "copy_size": F.col("size_bytes"),
            "copy_ext": F.col("ext"),
            "stem": health.document_stem(),
        }
    )
    ext, sign = F.col("ext"), F.col("sign")
    size, unreadable = sign * F.col("size_bytes"), health.unreadable_format(params.binary_exts)
    sums = {
        "n": sign,
        "bytes": size,
        "post": F.when(F.col("is_post"), sign),
        "doc": F.when((ext == "doc") & ~unreadable, size),
        "xls": F.when((ext == "xls") & ~unreadable, size),
        "docx": F.when(ext == "docx", sign),
        "xlsx": F.when(ext == "xlsx", sign),
        "unreadable": F.when(unreadable, size),
    }
    kind = F.coalesce(*[F.when(F.grouping(names[-1]) == 0, F.lit(kind)) for kind, names in KINDS.items()])
    sets = [[F.col(n) for n in names] for names in KINDS.values()]
    grouped = ready.groupingSets(sets, *KEYS)
    return grouped.agg(kind.alias("dim"), *[F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias(name) for name, value in sums.items()])


def merged(parts: DataFrame) -> DataFrame:
    """Cells of several batches as one; a cell without rows is gone."""
    sums = parts.groupBy("dim", *KEYS).agg(*[F.sum(name).alias(name) for name in SUMS])
    return sums.where("n <> 0")


def site_metrics(live: DataFrame, sites: DataFrame, accounts: DataFrame, params: Params) -> DataFrame:
    """Summary and health index of each site from its merged cells; ages count to `params.as_of`."""
    named = live.where("site IS NOT NULL").withColumn("last", of_dim("modified_ts", "modified_ts"))
    folders = live.withColumns({"has_docx": F.col("docx") > 0, "has_xlsx": F.col("xlsx") > 0})
    size, copies = F.col("copy_size"), F.col("n")
    extra = F.when((size > 0) & F.col("copy_name").isNotNull(), size * (copies - 1))
    junk = text.in_folder_named(F.col("folder"), params.junk_folders)
    volumes = folders.groupBy("site_url").agg(
        F.sum(of_dim("folder", "bytes")).alias("bytes"),
        F.sum(of_dim("modified_ts", F.when(health.is_active(params), F.col("bytes")))).alias("active_bytes"),
        F.sum(of_dim("copies", extra)).alias("dup_bytes"),
        F.sum(of_dim("folder", health.legacy_bytes())).alias("legacy_bytes"),
        F.sum(of_dim("folder", F.when(junk, F.col("bytes")))).alias("junk_bytes"),
    )
    scores = health.scored(volumes, ["site_url"], ["dup_bytes", "legacy_bytes", "junk_bytes"])
    dims = health.dimensions_of(scores, sites, accounts, params)
    indexed = health.maturity(health.site_index(dims, params.weights)).drop("bytes")
    return tenant.summary_of(named).join(indexed, "site_url", "left")
