"""Site inventory: what each site is and whether it should be surveyed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_health import constants as c
from corpus_health.functions import text
from corpus_health.functions.measures import half_even
from corpus_health.params import Params


def site_type(sites: DataFrame) -> DataFrame:
    """Readable type from the template; unknown templates stand for themselves."""
    template = F.col("template")
    kinds = [
        F.when(text.starts_with_any(template, [prefix]), F.lit(kind))
        for prefix, kind in c.SITE_TYPES.items()
    ]
    return sites.withColumn("site_type", F.coalesce(*kinds, template))


def site_class(
    sites: DataFrame,
    root_url: str = "",
    prefixes: Iterable[str] = (),
    label: str = c.LEGACY_LABEL,
) -> DataFrame:
    """Governance class of a site; the first rule that holds decides."""
    base = F.upper(F.substring_index("template", "#", 1))
    legacy = F.coalesce(base.isin(c.LEGACY_TEMPLATE_BASES), F.lit(False)) | text.starts_with_any(
        F.col("site"), prefixes
    )
    url = F.col("site_url")
    root = text.same_text(url, root_url) | text.same_text(url, root_url + "/")
    return sites.withColumn(
        "site_class",
        F.when(legacy, F.lit(label))
        .when(root, F.lit(c.ROOT_CLASS))
        .when(F.col("is_hub"), F.lit(c.HUB_CLASS))
        .when(_given_id("hub_id").isNotNull(), F.lit(c.SPOKE_CLASS))
        .otherwise(F.lit(c.STANDALONE_CLASS)),
    )


def site_columns(sites: DataFrame) -> DataFrame:
    """Inventory columns in reporting form.

    A site with `group_id` tells whether it has a group (`has_group`), and one with
    `created_ts` the day it was made. `survey_flag` is for people to fill in.
    """
    more = {}
    if "group_id" in sites.columns:
        more["has_group"] = _given_id("group_id").isNotNull()
    if "created_ts" in sites.columns:
        more["created_ts"] = F.date_trunc("day", F.col("created_ts")).cast("timestamp_ntz")
    if more and "survey_flag" not in sites.columns:
        more["survey_flag"] = F.lit(None).cast("string")
    mb = F.col("storage_mb")
    lock = F.col("lock_state")
    return sites.withColumns(
        {
            "storage_gb": half_even(mb / F.lit(1024.0), 2),
            "storage_mb": half_even(mb, 0),
            "owner": F.coalesce(F.nullif(F.col("owner"), F.lit("")), F.lit(c.NO_OWNER)),
            "hub_id": _given_id("hub_id"),
            **more,
            "lock_state": F.when(text.same_text(lock, c.UNLOCKED), F.lit(c.NOT_LOCKED)).otherwise(
                lock
            ),
        }
    )


def add_subsites(sites: DataFrame, subsites: DataFrame) -> DataFrame:
    """Append the subsites, named after their parent; what they lack stays NULL."""
    parents = sites.select(F.col("site_url").alias("parent_url"), F.col("site").alias("parent"))
    rows = subsites.join(parents, "parent_url", "left").select(
        "site",
        "site_url",
        F.lit(c.SUBSITE_CLASS).alias("site_class"),
        F.concat(F.lit(c.SUBSITE_TYPE_PREFIX), F.coalesce("parent", F.lit(""))).alias("site_type"),
        "template",
        F.lit(False).alias("is_hub"),
        F.lit(c.NOT_LOCKED).alias("lock_state"),
        "last_activity_ts",
    )
    return sites.unionByName(rows, allowMissingColumns=True)


def inventory_order(sites: DataFrame) -> DataFrame:
    """By class, largest first; sites of unknown size last."""
    return sites.orderBy("site_class", F.desc_nulls_last("storage_gb"), "site_url")


def class_counts(sites: DataFrame) -> DataFrame:
    counts = sites.groupBy("site_class").agg(F.count("*").alias("n_sites"))
    return counts.orderBy(F.desc("n_sites"), "site_class")


def inventory_totals(sites: DataFrame) -> DataFrame:
    """Sites, subsites and storage; subsites are counted apart and hold no storage."""
    sub = F.col("site_class") == c.SUBSITE_CLASS
    storage = F.sum(F.when(~sub, F.col("storage_gb").cast("decimal(18,2)")))
    return sites.agg(
        F.count_if(~sub).alias("n_sites"),
        F.count_if(sub).alias("n_subsites"),
        F.coalesce(storage.cast("double"), F.lit(0.0)).alias("storage_gb"),
    )


def is_legacy(
    sites: DataFrame,
    templates: Iterable[str] = tuple(c.LEGACY_TEMPLATES),
    prefixes: Iterable[str] = (),
) -> DataFrame:
    """Sites to be surveyed: by exact template family or by name prefix."""
    by_template = text.starts_with_any(F.col("template"), templates)
    by_name = text.starts_with_any(F.col("site"), prefixes)
    return sites.withColumn("is_legacy", by_template | by_name)


def exclude_sites(
    sites: DataFrame, ids: Iterable[str] = (), channel_prefixes: Iterable[str] = ()
) -> DataFrame:
    """Drop read-only sites, sites listed by id and channels of covered parents.

    Ids and prefixes are configuration lists, so the test stays in the filter
    and needs no join.
    """
    locked = text.same_text(F.col("lock_state"), c.READ_ONLY)
    listed = text.contains_any(F.col("site_url"), ids)
    covered = _channel() & text.starts_with_any(F.col("site"), channel_prefixes)
    return sites.where(~locked & ~listed & ~covered)


def survey_backlog(sites: DataFrame, params: Params) -> DataFrame:
    """Legacy, open, not excluded sites with content, largest first."""
    sites = is_legacy(sites, params.legacy_templates, params.legacy_prefixes)
    sites = exclude_sites(sites.where("is_legacy"), params.excluded_ids, params.channel_prefixes)
    return with_storage(sites).orderBy(F.desc("storage_gb"), "site_url")


def with_storage(sites: DataFrame) -> DataFrame:
    """Sites that hold content; storage text may use a decimal comma."""
    number = F.replace(F.col("storage_gb").cast("string"), F.lit(","), F.lit("."))
    return sites.withColumn("storage_gb", number.try_cast("double")).where("storage_gb > 0")


def backlog_totals(sites: DataFrame) -> DataFrame:
    storage = F.sum(F.col("storage_gb").cast("decimal(18,2)")).cast("double")
    return sites.agg(
        F.count("*").alias("n_sites"),
        F.coalesce(half_even(storage, 1), F.lit(0.0)).alias("storage_gb"),
    )


def single_site(sites: DataFrame, url: str) -> DataFrame:
    """Restrict a run to one site."""
    return sites.where(text.same_text(F.col("site_url"), url))


def run_kind() -> Column:
    """How a run summary names the kind of site."""
    return F.when(_channel(), F.lit("CANAL")).otherwise(F.lit("TeamSite"))


def refresh_candidates(sites: DataFrame, params: Params) -> DataFrame:
    """Sites a refresh considers: legacy by class, open, not a covered channel, with content."""
    sites = sites.where(text.same_text(F.col("site_class"), params.legacy_label))
    return with_storage(exclude_sites(sites, (), params.channel_prefixes))


def _channel() -> Column:
    return text.same_text(F.col("site_type"), c.CHANNEL_TYPE)


def _given_id(name: str) -> Column:
    """An id, NULL when it is the all-zero placeholder or blank."""
    return F.nullif(F.nullif(F.col(name), F.lit(c.NO_ID)), F.lit(""))
