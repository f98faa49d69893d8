"""Health index: six dimensions per site, weighted into one number from 0 to 100.

Operators over files take a clean, enriched frame (`ext`, `folder` present) and
the grouping `keys`, by default one row per site.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_health import constants as c
from corpus_health.functions import text, times
from corpus_health.functions.measures import big_sum, gb, pct, total
from corpus_health.params import Params, check_weights
from corpus_health.plans.skew import heavy_join, heavy_keys
from corpus_health.sources.shared import landed

SITE_KEY = ("site_url",)
DIMENSIONS = tuple(c.WEIGHTS)


# --- dimensions that need the inventory only ---------------------------------


def score_ownership(
    sites: DataFrame,
    accounts: DataFrame,
    owners: DataFrame | None = None,
    members: DataFrame | None = None,
) -> DataFrame:
    """100 with an enabled personal owner, 50 with only shared ones, else 0.

    `owners` lists (site_url, owner) when a site may have several. `members` lists
    (site_url, member): a site without any owner has 50 if a member is enabled.
    """
    owners = sites.select("site_url", "owner") if owners is None else owners
    # an account listed more than once counts by its best line
    known = accounts.groupBy(F.col("account").alias("owner")).agg(
        F.bool_or("enabled").alias("enabled"),
        F.bool_or(F.col("enabled") & ~F.col("is_generic")).alias("personal"),
    )
    points = (
        F.when(F.col("personal"), 100).when(F.col("enabled"), 50).otherwise(0)
    )
    named = owners.where(F.nullif(F.col("owner"), F.lit("")).isNotNull())
    best = (
        named.join(known, "owner", "left").groupBy("site_url").agg(F.max(points).alias("ownership"))
    )
    scored = sites.select("site_url").join(best, "site_url", "left")
    if members is not None:
        enabled = known.where("enabled").select(F.col("owner").alias("member"))
        peopled = members.join(enabled, "member").groupBy("site_url").agg(F.lit(50).alias("_peopled"))
        scored = scored.join(peopled, "site_url", "left")
        scored = scored.withColumn("ownership", F.coalesce("ownership", "_peopled"))
    return scored.select("site_url", F.coalesce("ownership", F.lit(0)).cast("double").alias("ownership"))


def architecture(name_patterns: Iterable[str] = ()) -> Column:
    """100 for a hub, a site of a hub, or a name that follows a convention."""
    hub_id = F.nullif(F.nullif(F.col("hub_id"), F.lit(c.NO_ID)), F.lit(""))
    governed = F.coalesce(F.col("is_hub"), F.lit(False)) | hub_id.isNotNull()
    for pattern in name_patterns:
        governed = governed | F.coalesce(F.col("site").rlike(pattern), F.lit(False))
    return _all_or_nothing(governed)


def sharing() -> Column:
    return _all_or_nothing(F.coalesce(F.col("sharing").isin(c.CONTROLLED_SHARING), F.lit(False)))


def lifecycle() -> Column:
    return _all_or_nothing(F.coalesce(F.col("has_retention"), F.lit(False)))


def score_architecture(sites: DataFrame, name_patterns: Iterable[str] = ()) -> DataFrame:
    return sites.select("site_url", architecture(name_patterns).alias("architecture"))


def score_sharing(sites: DataFrame) -> DataFrame:
    return sites.select("site_url", sharing().alias("sharing"))


def score_lifecycle(sites: DataFrame) -> DataFrame:
    return sites.select("site_url", lifecycle().alias("lifecycle"))


def _all_or_nothing(holds: Column) -> Column:
    return F.when(holds, F.lit(100.0)).otherwise(F.lit(0.0))


# --- volumes of noise ---------------------------------------------------------


def dup_volume(
    files: DataFrame, similar: float | None = None, keys: Sequence[str] = SITE_KEY
) -> DataFrame:
    """Bytes of extra copies: same name, size and extension.

    With `similar`, a copy counts only when its folders resemble those of the
    kept copy (the first by path): shared names / all names >= `similar`.
    """
    copy_of = [*keys, "file_name", "size_bytes", "ext"]
    sized = _of_sites(files, keys).where("size_bytes > 0 AND file_name IS NOT NULL")
    if similar is None:
        groups = sized.groupBy(*copy_of).agg(F.count("*").alias("copies"))
        extra = F.col("size_bytes") * (F.col("copies") - 1)
        return groups.groupBy(*keys).agg(F.sum(extra).alias("dup_bytes"))

    # one row per folder of a group: copies in the same folder share the answer
    by_folder = (
        sized.withColumns({"ext": F.coalesce("ext", F.lit("")), "folder": _folder()})
        .groupBy(*copy_of, "folder")
        .agg(
            F.count("*").alias("n"),
            F.min(F.coalesce("path", F.lit(""))).alias("path"),
            F.max(F.xxhash64(*copy_of)).alias("_key"),  # of the group
        )
    )
    by_folder = landed(by_folder, "folders-of-copies")  # read below by sketch, kept copies and both joins: one scan of the files
    kept = (
        by_folder.groupBy(*copy_of)
        .agg(F.min(F.struct("path", "folder")).alias("kept"), F.sum("n").alias("copies"), F.max("_key").alias("_key"))
        .where("copies > 1")
        .select(*copy_of, "_key", F.col("kept.folder").alias("kept_folder"))
    )
    # each row by itself: the kept copy's folder gives all its copies but the kept one. The folders
    # of a name that very many folders hold are compared in several tasks
    compared = heavy_join(by_folder, kept, copy_of, "_key", heavy_keys(by_folder, "_key"))
    alike = folder_similarity(F.col("folder"), F.col("kept_folder")) >= similar
    counted = F.when(alike, F.col("n")).otherwise(0) - F.when(
        F.col("folder") == F.col("kept_folder"), 1
    ).otherwise(0)
    return compared.groupBy(*keys).agg(F.sum(F.col("size_bytes") * counted).alias("dup_bytes"))


def folder_similarity(a: Column, b: Column) -> Column:
    """Shared folder names over all folder names; 1 for two files without folder."""
    a, b = (F.array_remove(text.folder_parts(f), "") for f in (a, b))
    names = F.size(F.array_union(a, b))
    return F.when(names == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / names)


def legacy_volume(
    files: DataFrame, binary_exts: Iterable[str] = (), keys: Sequence[str] = SITE_KEY
) -> DataFrame:
    """Bytes of formats a search engine cannot read well.

    Old documents without a converted file of the same name beside them, zips
    over the migration limit, and any listed binary format.
    """
    readable_too = F.col("ext").isin("doc", "docx", "xls", "xlsx")
    some = _of_sites(files, keys).where(readable_too | unreadable_format(binary_exts))
    cells = _folder_cells(some, binary_exts, keys)
    return cells.groupBy(*keys).agg(F.sum(legacy_bytes()).alias("legacy_bytes"))


def _folder_cells(
    files: DataFrame, binary_exts: Iterable[str], keys: Sequence[str], **more: Column
) -> DataFrame:
    """Sums per folder; documents in a cell with those of the same name.

    A converted file sits in the cell of its original, so no join looks for it.
    All other files share one cell per folder.
    """
    ext, size = F.col("ext"), F.col("size_bytes")
    unreadable = unreadable_format(binary_exts)
    return files.groupBy(*keys, "folder", document_stem().alias("stem")).agg(
        F.sum(F.when((ext == "doc") & ~unreadable, size)).alias("doc"),
        F.sum(F.when((ext == "xls") & ~unreadable, size)).alias("xls"),
        F.coalesce(F.bool_or(ext == "docx"), F.lit(False)).alias("has_docx"),
        F.coalesce(F.bool_or(ext == "xlsx"), F.lit(False)).alias("has_xlsx"),
        F.sum(F.when(unreadable, size)).alias("unreadable"),
        *[value.alias(name) for name, value in more.items()],
    )


def document_stem() -> Column:
    """What an original and its converted file are called alike; NULL for all other files."""
    document = F.col("ext").isin("doc", "docx", "xls", "xlsx")
    return F.when(document, text.file_stem(F.col("file_name")))


def legacy_bytes() -> Column:
    """Legacy bytes of a folder cell."""
    zero = F.lit(0).cast("bigint")
    return (
        F.coalesce(F.when(~F.col("has_docx"), F.col("doc")), zero)
        + F.coalesce(F.when(~F.col("has_xlsx"), F.col("xls")), zero)
        + F.coalesce("unreadable", zero)
    )


def junk_volume(
    files: DataFrame, names: Iterable[str] = tuple(c.JUNK_FOLDERS), keys: Sequence[str] = SITE_KEY
) -> DataFrame:
    """Bytes below a folder that marks content as discarded."""
    junk = _of_sites(files, keys).where(text.in_folder_named(F.col("folder"), names))
    return junk.groupBy(*keys).agg(F.sum("size_bytes").alias("junk_bytes"))


def noise_volume(files: DataFrame, params: Params, keys: Sequence[str] = SITE_KEY) -> DataFrame:
    """Bytes that are duplicate, legacy or junk, each file counted once."""
    junk = text.in_folder_named(F.col("folder"), params.junk_folders)
    rows = (
        _of_sites(files, keys)
        .withColumns({"ext": F.coalesce("ext", F.lit("")), "folder": _folder()})
        .groupBy(*keys, "folder", "file_name", "size_bytes", "ext")
        .agg(F.count("*").alias("n"), F.min("path").alias("path"))
        .withColumn("stem", F.coalesce(text.file_stem(F.col("file_name")), F.lit("")))
        .withColumn("marked", junk | unreadable_format(params.binary_exts))
    )
    # a converted file stands beside its original: same folder and stem, the same format's newer
    # extension; other formats share no cell, so a folder of them is not put in one place
    document = F.when(F.col("ext").isin("doc", "docx"), "doc").when(
        F.col("ext").isin("xls", "xlsx"), "xls"
    )
    apart = F.when(document.isNull(), F.xxhash64("file_name", "size_bytes", "ext"))
    beside = Window.partitionBy(*keys, "folder", "stem", "_document", "_apart")
    converted = F.max(F.col("ext").isin("docx", "xlsx")).over(beside)
    old = F.col("ext").isin("doc", "xls")
    flagged = (
        rows.withColumns({"_document": document, "_apart": apart})
        .withColumn("marked", F.col("marked") | (old & ~converted))
        .drop("_document", "_apart")
        .where("size_bytes > 0")
    )
    # copies after the first are noise; the first is noise only when marked itself
    groups = flagged.groupBy(*keys, "file_name", "size_bytes", "ext").agg(
        F.sum("n").alias("copies"),
        F.sum(F.when(F.col("marked"), F.col("n")).otherwise(0)).alias("n_marked"),
        F.min_by("marked", F.coalesce("path", F.lit(""))).alias("first_marked"),
    )
    noisy = F.when(F.col("file_name").isNull(), F.col("n_marked")).otherwise(
        F.col("copies") - 1 + F.col("first_marked").cast("bigint")
    )
    return groups.groupBy(*keys).agg(F.sum(F.col("size_bytes") * noisy).alias("noise_bytes"))


def unreadable_format(binary_exts: Iterable[str]) -> Column:
    big_zip = (F.col("ext") == "zip") & (F.col("size_bytes") > c.MIGRATION_LIMIT_BYTES)
    listed = [e.lower() for e in binary_exts]
    out = big_zip | F.col("ext").isin(listed) if listed else big_zip
    return F.coalesce(out, F.lit(False))


def _folder() -> Column:
    return F.coalesce("folder", F.lit(""))


def _of_sites(files: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in keys:
        files = files.where(F.col(key).isNotNull())
    return files


# --- dimensions that need the files -------------------------------------------


def is_active(params: Params) -> Column:
    """Changed in the days up to the one that ages are counted to."""
    first, last = times.days_before(params.today, params.activity_days), times.timestamp(params.today)
    return times.within(F.col("modified_ts"), first, last)


def file_scores(
    files: DataFrame,
    params: Params,
    keys: Sequence[str] = SITE_KEY,
    similar: float | None = None,
    overlap: str = "sum",
) -> DataFrame:
    """Bytes, quality and activity per key.

    `overlap="sum"` adds the three noise volumes, floor 0; `"union"` counts each
    file once. Without volume there is nothing to score: NULL.
    """
    if overlap not in ("sum", "union"):
        raise ValueError("overlap must be 'sum' or 'union'")
    keys = list(keys)
    size, active = F.col("size_bytes"), is_active(params)
    # total, active, legacy and junk bytes from one pass, by way of folder cells
    folders = _folder_cells(
        _of_sites(files, keys),
        params.binary_exts,
        keys,
        bytes=F.sum(size),
        active_bytes=F.sum(F.when(active, size)),
    )
    junk = text.in_folder_named(F.col("folder"), params.junk_folders)
    volumes = folders.groupBy(*keys).agg(
        F.sum("bytes").alias("bytes"),
        F.sum("active_bytes").alias("active_bytes"),
        F.sum(legacy_bytes()).alias("legacy_bytes"),
        F.sum(F.when(junk, F.col("bytes"))).alias("junk_bytes"),
    )
    if overlap == "union":
        parts = ["noise_bytes"]
        noise = noise_volume(files, params, keys)
    else:
        parts = ["dup_bytes", "legacy_bytes", "junk_bytes"]
        noise = dup_volume(files, similar, keys)
    return scored(volumes.join(noise, keys, "left"), keys, parts)


def scored(volumes: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """Quality and activity from the bytes of each key: all, active, and the `parts` that are noise."""
    joined = volumes.withColumns(
        {p: F.coalesce(p, F.lit(0).cast("bigint")) for p in [*parts, "active_bytes"]}
    )
    noise_bytes = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return joined.select(
        *keys,
        "bytes",
        *parts,
        F.when(F.col("bytes") > 0, F.greatest(100.0 - _share(noise_bytes), F.lit(0.0))).alias(
            "quality"
        ),
        F.when(F.col("bytes") > 0, _share(F.col("active_bytes"))).alias("activity"),
    )


def score_quality(files: DataFrame, params: Params, **options) -> DataFrame:
    scores = file_scores(files, params, **options)
    return scores.drop("activity")


def score_activity(files: DataFrame, as_of: datetime, days: int = 90) -> DataFrame:
    """Share of bytes changed in the days up to `as_of`."""
    recent = times.within(
        F.col("modified_ts"), times.days_before(as_of, days), times.timestamp(as_of)
    )
    sums = _of_sites(files, SITE_KEY).groupBy("site_url").agg(
        F.sum("size_bytes").alias("bytes"),
        F.sum(F.when(recent, F.col("size_bytes")).otherwise(0)).alias("active_bytes"),
    )
    return sums.withColumn(
        "activity", F.when(F.col("bytes") > 0, _share(F.col("active_bytes")))
    )


def _share(part: Column) -> Column:
    return part.cast("double") / F.col("bytes").cast("double") * F.lit(100.0)


def dimensions(
    files: DataFrame,
    sites: DataFrame,
    accounts: DataFrame,
    params: Params,
    owners: DataFrame | None = None,
    version: str | None = None,
    **options,
) -> DataFrame:
    """The six dimensions of every site, and its bytes.

    With `version` there is one row per (survey, site) that has files.
    """
    keys = ["site_url"] if version is None else [version, "site_url"]
    by_files = file_scores(files, params, keys, **options)
    return dimensions_of(by_files, sites, accounts, params, owners, keys)


def dimensions_of(
    by_files: DataFrame,
    sites: DataFrame,
    accounts: DataFrame,
    params: Params,
    owners: DataFrame | None = None,
    keys: Sequence[str] = SITE_KEY,
) -> DataFrame:
    """The same from the scores that need the files; all sites of the inventory where they are the only key."""
    by_inventory = sites.select(
        "site_url",
        architecture(params.name_patterns).alias("architecture"),
        sharing().alias("sharing"),
        lifecycle().alias("lifecycle"),
    ).join(score_ownership(sites, accounts, owners), "site_url")
    dims = by_inventory.join(by_files, "site_url", "left" if len(keys) == 1 else "inner")
    return dims.select(
        *keys,
        F.coalesce("bytes", F.lit(0).cast("bigint")).alias("bytes"),
        *DIMENSIONS,
    )


# --- the index -----------------------------------------------------------------


def index(weights: Mapping[str, float] = c.WEIGHTS) -> Column:
    """Weighted sum of the dimensions; NULL when one of them is unknown."""
    check_weights(weights)
    terms = [F.col(d) * F.lit(float(weights[d])) for d in DIMENSIONS]
    return sum(terms[1:], terms[0])


def site_index(dims: DataFrame, weights: Mapping[str, float] = c.WEIGHTS) -> DataFrame:
    return dims.withColumn("health", index(weights))


def weighted_mean(score: Column | str) -> Column:
    """Mean of a site score weighted by bytes; sites without the score have no weight."""
    score = F.col(score) if isinstance(score, str) else score
    weight = F.col("bytes").cast("double")
    known = F.sum(F.when(score.isNotNull(), weight))
    return F.when(known > 0, F.sum(score * weight) / known)


def tenant_index(indexed: DataFrame) -> DataFrame:
    return indexed.agg(weighted_mean("health").alias("health"))


def reconciliation(files: DataFrame, sites: DataFrame) -> DataFrame:
    """One row: what of files and inventory the index can weigh, and what each side has alone.

    `listed_*` are sites with files that the inventory lists, `unlisted_*` those it does
    not list, `unplaced_*` files that name no site, and `empty_sites` the listed ones
    without a file. All files of the survey are in one of the three.
    """
    found = files.groupBy("site_url").agg(F.count("*").alias("files"), F.sum("size_bytes").alias("bytes"))
    listed = sites.where(F.col("site_url").isNotNull()).groupBy("site_url").agg(F.lit(True).alias("listed"))
    both = found.join(listed, "site_url", "full")
    has_files, is_listed = F.col("files").isNotNull(), F.col("listed").isNotNull()
    parts = {
        "listed": has_files & is_listed,
        "unlisted": has_files & ~is_listed & F.col("site_url").isNotNull(),
        "unplaced": has_files & F.col("site_url").isNull(),
    }
    sums = []
    for name, of in parts.items():
        sums += [F.count_if(of).alias(f"{name}_sites")] if name != "unplaced" else []
        sums += [
            total(F.when(of, F.col("files"))).alias(f"{name}_files"),
            F.coalesce(gb(big_sum(F.when(of, F.col("bytes")))), F.lit(0.0)).alias(f"{name}_gb"),
        ]
    return both.agg(*sums, F.count_if(is_listed & ~has_files).alias("empty_sites"))


def tenant_index_reconciled(indexed: DataFrame, files: DataFrame, sites: DataFrame) -> DataFrame:
    """The index of the estate beside what it leaves out, and the share of volume that it weighs."""
    known = reconciliation(files, sites)
    volume = F.col("listed_gb") + F.col("unlisted_gb") + F.col("unplaced_gb")
    weighed = known.withColumn("pct_weighed", pct(F.col("listed_gb"), volume))
    return weighed.withColumn("health", tenant_index(indexed).scalar())


def stage(health: Column) -> Column:
    return (
        F.when(health < c.CURATION_FROM, c.BASELINE_STAGE)
        .when(health < c.READY_FROM, c.CURATION_STAGE)
        .when(health.isNotNull(), c.READY_STAGE)
    )


def maturity(indexed: DataFrame) -> DataFrame:
    return indexed.withColumn("maturity", stage(F.col("health")))


def tenant_dimensions(dims: DataFrame) -> DataFrame:
    """One row per dimension: its mean over the estate, weighted by bytes."""
    means = dims.agg(*[weighted_mean(d).alias(d) for d in DIMENSIONS])
    return means.unpivot([], list(DIMENSIONS), "dimension", "score")


def index_trend(indexed: DataFrame, version: str = "survey_no") -> DataFrame:
    """Estate index per survey and its change from the one before; see `estate_trend` for surveys of some sites."""
    per_survey = indexed.groupBy(version).agg(weighted_mean("health").alias("health"))
    # one row per survey of the estate: a handful a year
    before = F.lag("health").over(Window.orderBy(version))
    return per_survey.withColumn("change", F.col("health") - before)


def carried(indexed: DataFrame, version: str = "survey_no") -> DataFrame:
    """One row per survey and site that was surveyed by then: its last row so far, and `scored_in`, the survey it is of.

    A refresh surveys some sites only; the others keep the score they had. A site whose
    last survey found no volume has no score from then on, until it is surveyed again.
    """
    # the surveys of the estate, a handful a year, in each row; each score counts up to the site's next survey
    surveys = indexed.select(F.sort_array(F.collect_set(version))).scalar()
    following = F.lead(version).over(Window.partitionBy("site_url").orderBy(version))
    rows = indexed.where(F.col("site_url").isNotNull()).withColumns({"_until": following, "_surveys": surveys})
    counts = F.filter("_surveys", lambda s: (s >= F.col(version)) & (F.col("_until").isNull() | (s < F.col("_until"))))
    rest = [name for name in indexed.columns if name != version]
    return rows.select(F.explode(counts).alias(version), F.col(version).alias("scored_in"), *rest)


def estate_trend(indexed: DataFrame, version: str = "survey_no") -> DataFrame:
    """Estate index after each survey, also one of some sites, and its change from the one before.

    `sites` were surveyed by then, `carried` of them not in this survey.
    """
    rows = carried(indexed, version)
    after = rows.groupBy(version).agg(
        weighted_mean("health").alias("health"),
        F.count("*").alias("sites"),
        F.count_if(F.col("scored_in") < F.col(version)).alias("carried"),
    )
    before = F.lag("health").over(Window.orderBy(version))  # one row per survey
    return after.withColumn("change", F.col("health") - before)


def reweight(dims: DataFrame, profiles: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """The index of every site under each weight profile."""
    scored = [
        F.struct(F.lit(name).alias("profile"), index(weights).alias("health"))
        for name, weights in profiles.items()
    ]
    return dims.select("site_url", "bytes", F.explode(F.array(*scored)).alias("p")).select(
        "site_url", "bytes", "p.*"
    )


def stale_sites(files: DataFrame, as_of: datetime, years: int = 2) -> DataFrame:
    """Sites where more than half of the content was not touched for years."""
    old = times.before(F.col("modified_ts"), times.years_before(as_of, years))
    sums = _of_sites(files, SITE_KEY).groupBy("site_url").agg(
        F.sum("size_bytes").alias("bytes"),
        F.sum(F.when(old, F.col("size_bytes")).otherwise(0)).alias("stale_bytes"),
    )
    return sums.where(F.col("stale_bytes") > F.col("bytes") - F.col("stale_bytes")).withColumn(
        "pct_stale", _share(F.col("stale_bytes"))
    )


def health_index(
    files: DataFrame,
    sites: DataFrame,
    accounts: DataFrame,
    params: Params,
    owners: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Files, inventory and accounts in; dimensions, index and maturity per site out."""
    dims = dimensions(files, sites, accounts, params, owners, **options)
    return maturity(site_index(dims, params.weights))
