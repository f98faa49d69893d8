"""Raw library listings, as a tenant returns them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_health.functions import measures, text, times


def normalize_listing(items: DataFrame) -> DataFrame:
    """Listed items -> survey rows: files only, with extension, path parts and sizes.

    Expects site, site_url, library, object_type, file_ref, file_leaf,
    file_type, file_size, created_ts, modified_ts, author and editor (structs
    with `lookup_value`), version and checkout_user.
    """
    files = items.where(text.same_text(F.col("object_type"), "File"))
    ext = F.lower(F.coalesce("file_type", F.lit("")))
    size = F.coalesce(F.col("file_size").try_cast("bigint"), F.lit(0).cast("bigint"))
    rel_path = text.relative_path(F.col("file_ref"), F.col("site_url"))
    return files.select(
        "site",
        "site_url",
        "library",
        F.col("file_ref").alias("path"),
        text.folder_of(rel_path, F.col("file_leaf")).alias("folder"),
        F.col("file_leaf").alias("file_name"),
        ext.alias("ext"),
        text.category(ext).alias("category"),
        size.alias("size_bytes"),
        measures.kib(size).alias("size_kb"),
        measures.mib(size).alias("size_mb"),
        times.to_minute(F.col("created_ts")).alias("created_ts"),
        times.to_minute(F.col("modified_ts")).alias("modified_ts"),
        F.col("author.lookup_value").alias("created_by"),
        F.col("editor.lookup_value").alias("modified_by"),
        "version",
        (F.coalesce(F.col("checkout_user"), F.lit("")) != "").alias("checked_out"),
        text.depth_of(rel_path).alias("depth"),
    )
