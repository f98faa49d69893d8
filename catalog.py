"""Every registered query: the operator on the fixture tables, and the same in DuckDB SQL.

A query function takes an `Estate` and returns a DataFrame; `@query` keeps it
with the SQL that must give the same rows, and the views that SQL reads.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import fixtures
from corpus_health import constants as c
from corpus_health.functions import text
from corpus_health.operators import (
    clean, debt, health, inventory, portfolio, refresh, site, tenant,
)
from corpus_health.plans import report, store
from corpus_health.schemas import INVENTORY_COLUMNS, RUN_COLUMNS, SURVEY_COLUMNS
from corpus_health.sources import inventory as inventory_runs
from corpus_health.sources import listing, sinks, surveys
from corpus_health.sources.shared import work_dir
from corpus_health.streaming import files as streams

PARAMS = fixtures.PARAMS
LISTS = PARAMS.with_(
    root_url="https://tenant.example/sites/s9",
    legacy_prefixes=("supplier#00000002",),
    excluded_ids=("sites/s1", "SITES/S77"),
    channel_prefixes=("Supplier#00000004",),
    name_patterns=(r"^Supplier#0+1\d?$",),
)
PROFILES = {
    "standard": c.WEIGHTS,
    "regulated": {"ownership": 0.2, "architecture": 0.15, "sharing": 0.35, "quality": 0.15,
                  "lifecycle": 0.1, "activity": 0.05},
    "archive": {"ownership": 0.3, "architecture": 0.2, "sharing": 0.2, "quality": 0.15,
                "lifecycle": 0.13, "activity": 0.02},
}


class Estate:
    """Fixture tables of one scale factor, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = fixtures.load(self.spark, self.sf_dir, name)
        return self._tables[name]

    @cached_property
    def files(self) -> DataFrame:
        return self.table("files")

    @cached_property
    def clean(self) -> DataFrame:
        return clean.enrich(self.files, PARAMS)

    @cached_property
    def sites(self) -> DataFrame:
        return self.table("sites")

    @cached_property
    def inventory(self) -> DataFrame:
        typed = inventory.site_class(inventory.site_type(self.sites))
        return inventory.site_columns(typed)

    @cached_property
    def summary(self) -> DataFrame:
        return tenant.site_summary(self.clean)

    @cached_property
    def coverage(self) -> DataFrame:
        return portfolio.report_coverage(
            self.summary, self.table("reports"), self.table("artifacts")
        )

    @cached_property
    def dims(self) -> DataFrame:
        return health.dimensions(self.clean, self.sites, self.table("accounts"), PARAMS)

    @cached_property
    def indexed(self) -> DataFrame:
        return health.site_index(self.dims)

    @cached_property
    def stored(self) -> DataFrame:
        return store.land(self.clean, PARAMS)

    def folder(self, name: str) -> str:
        return work_dir(self.spark, name)


@dataclass(frozen=True)
class Query:
    run: Callable[[Estate], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, views: tuple[str, ...] = ("clean",), overrides: dict[str, str] | None = None):
    def register(run):
        QUERIES[run.__name__] = Query(run, None if sql is None else duckdb_sql(sql, views, overrides))
        return run

    return register


# --- DuckDB side: derived views ----------------------------------------------


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


CATEGORY = "CASE " + " ".join(
    f"WHEN ext IN {_in(exts)} THEN '{name}'" for name, exts in c.CATEGORIES.items()
) + f" ELSE '{c.OTHER_CATEGORY}' END"
EXT = "CASE WHEN file_name NOT LIKE '%.%' THEN '' ELSE lower(string_split(file_name, '.')[-1]) END"
REL = "substr(path, length(replace(site_url, 'https://tenant.example', '')) + 2)"
KEPT_LIBRARY = f"(library IS NULL OR library NOT IN {_in(c.SYSTEM_LIBRARIES)})"
KEPT_FILE = f"(file_name IS NULL OR file_name NOT IN {_in(c.SYSTEM_FILES)})"
POST = "coalesce(modified_ts > TIMESTAMP '1999-07-01', false)"
INACTIVE = "coalesce(modified_ts < TIMESTAMP '1997-07-01', false)"
TOP_FOLDER = (
    "coalesce(list_filter(string_split(folder, '/'), lambda x: x NOT IN "
    f"{_in(c.ROOT_FOLDERS)})[1], '{c.NO_FOLDER}')"
)
JUNK = "list_has_any(string_split(upper(folder), '/'), ['SUPERADO', 'BORRADORES', 'TMP'])"
BIG_ZIP = "(ext = 'zip' AND size_bytes > 262144000)"
REC = (
    f"CASE WHEN post = 0 THEN '{c.ARCHIVE}' WHEN post * 100 >= files * 30 THEN '{c.ACTIVE}' "
    f"ELSE '{c.REVIEW}' END"
)


def _clean(source: str) -> str:
    return f"""
SELECT *, {CATEGORY} AS category, round_even(size_bytes / 1024e0, 1) AS size_kb,
  round_even(size_bytes / 1048576e0, 2) AS size_mb,
  CAST(length({REL}) - length(replace({REL}, '/', '')) AS INTEGER) AS depth,
  {POST} AS is_post, {INACTIVE} AS is_inactive
FROM (SELECT *, {EXT} AS ext FROM {source}) WHERE {KEPT_LIBRARY} AND {KEPT_FILE}"""


SUMMARY = f"""
SELECT s.*, bytes / 1e9 AS gb, post::DOUBLE / files * 100 AS pct_post, {REC} AS recommendation,
  top_category
FROM (SELECT site, site_url, count(*) AS files, sum(size_bytes)::BIGINT AS bytes,
    count(*) FILTER (WHERE is_post) AS post, max(modified_ts) AS last_modified,
    count(DISTINCT modified_by) AS users, count(DISTINCT library) AS libraries
  FROM clean GROUP BY ALL) s
JOIN (SELECT site_url, category AS top_category FROM
    (SELECT site_url, category, count(*) AS n FROM clean GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY site_url ORDER BY n DESC, category) = 1) t USING (site_url)"""

BAND = "CASE WHEN gb >= 10 THEN 'main' WHEN gb >= 1 THEN 'mid' ELSE 'minor' END"

COVERAGE = f"""
SELECT s.*, CASE WHEN l.artifact IS NOT NULL THEN l.artifact ELSE g.artifact END AS report,
  CASE WHEN l.artifact IS NOT NULL AND l.artifact IN (SELECT artifact FROM artifacts) THEN '{c.LISTED}'
    WHEN l.artifact IS NOT NULL THEN '{c.LISTED_MISSING}'
    WHEN g.artifact IS NOT NULL THEN '{c.GENERATED}' END AS report_kind
FROM summary s
LEFT JOIN (SELECT * FROM reports QUALIFY row_number() OVER (PARTITION BY site_url ORDER BY ordinal) = 1) l
  USING (site_url)
LEFT JOIN (SELECT * FROM artifacts
  QUALIFY row_number() OVER (PARTITION BY site_url ORDER BY written_ts DESC, artifact DESC) = 1) g
  USING (site_url)"""

SITE_TYPE = "CASE " + " ".join(
    f"WHEN starts_with(upper(template), '{p}') THEN '{t}'" for p, t in c.SITE_TYPES.items()
) + " ELSE template END"


def _site_class(root: str = "", prefix: str | None = None) -> str:
    named = f"OR starts_with(lower(site), '{prefix.lower()}')" if prefix else ""
    return f"""CASE WHEN upper(string_split(template, '#')[1]) IN ('GROUP', 'TEAMCHANNEL') {named}
      THEN '{c.LEGACY_LABEL}'
    WHEN site_url IN ('{root}', '{root}/') THEN '{c.ROOT_CLASS}' WHEN is_hub THEN '{c.HUB_CLASS}'
    WHEN hub_id <> '{c.NO_ID}' THEN '{c.SPOKE_CLASS}' ELSE '{c.STANDALONE_CLASS}' END"""


INVENTORY = f"""
SELECT site, site_url, template, is_hub, nullif(hub_id, '{c.NO_ID}') AS hub_id,
  round_even(storage_mb / 1024e0, 2) AS storage_gb, round_even(storage_mb, 0) AS storage_mb,
  coalesce(owner, '{c.NO_OWNER}') AS owner, sharing,
  CASE WHEN lock_state = 'Unlock' THEN 'No' ELSE lock_state END AS lock_state,
  has_retention, last_activity_ts, {SITE_TYPE} AS site_type, {_site_class()} AS site_class
FROM sites"""

LATEST = """
SELECT * FROM files QUALIFY row_number() OVER (PARTITION BY site_url, path ORDER BY
  survey_no DESC NULLS LAST, site DESC NULLS LAST, library DESC NULLS LAST, folder DESC NULLS LAST,
  file_name DESC NULLS LAST, size_bytes DESC NULLS LAST, created_ts DESC NULLS LAST,
  modified_ts DESC NULLS LAST, created_by DESC NULLS LAST, modified_by DESC NULLS LAST,
  checked_out DESC NULLS LAST) = 1"""

DUPS = """
SELECT site_url, file_name, size_bytes, count(*) AS copies, size_bytes * (count(*) - 1) AS extra_bytes
FROM clean WHERE size_bytes > 0 GROUP BY site_url, file_name, size_bytes HAVING count(*) > 1"""


def _flagged(keys: str) -> str:
    """Every clean file with its three noise flags."""
    return f"""
SELECT f.*, {JUNK} AS junk, regexp_replace(lower(file_name), '\\.[^.]*$', '') AS stem,
  row_number() OVER (PARTITION BY {keys}, file_name, size_bytes, ext ORDER BY path) AS copy_no,
  {BIG_ZIP} OR (ext IN ('doc', 'xls') AND NOT list_contains(
    list(ext) OVER (PARTITION BY {keys}, folder, regexp_replace(lower(file_name), '\\.[^.]*$', '')),
    ext || 'x')) AS legacy
FROM clean f"""


def _dims(keys: str) -> str:
    file_scores = f"""
SELECT {keys}, sum(size_bytes)::BIGINT AS bytes,
  greatest(100 - (sum(CASE WHEN copy_no > 1 THEN size_bytes ELSE 0 END)
    + sum(CASE WHEN legacy THEN size_bytes ELSE 0 END)
    + sum(CASE WHEN junk THEN size_bytes ELSE 0 END))::DOUBLE / sum(size_bytes)::DOUBLE * 100, 0) AS quality,
  coalesce(sum(size_bytes) FILTER (WHERE modified_ts BETWEEN TIMESTAMP '2001-08-07' AND TIMESTAMP '2001-11-05'), 0)::DOUBLE
    / sum(size_bytes)::DOUBLE * 100 AS activity
FROM ({_flagged(keys)}) GROUP BY {keys}"""
    join = "LEFT JOIN" if keys == "site_url" else "JOIN"
    return f"""
SELECT {keys}, coalesce(bytes, 0) AS bytes,
  CASE WHEN enabled AND NOT is_generic THEN 100e0 WHEN enabled THEN 50e0 ELSE 0e0 END AS ownership,
  CASE WHEN is_hub OR hub_id <> '{c.NO_ID}' THEN 100e0 ELSE 0e0 END AS architecture,
  CASE WHEN sharing IN ('Disabled', 'ExistingExternalUserSharingOnly') THEN 100e0 ELSE 0e0 END AS sharing,
  quality, CASE WHEN has_retention THEN 100e0 ELSE 0e0 END AS lifecycle, activity
FROM sites LEFT JOIN accounts ON owner = account {join} ({file_scores}) USING (site_url)"""


def _index(w=c.WEIGHTS) -> str:
    return " + ".join(f"{d} * {w[d]!r}::DOUBLE" for d in c.WEIGHTS)


STAGE = "CASE WHEN health < 36 THEN 'baseline' WHEN health < 70 THEN 'curation' ELSE 'ready' END"

# name -> (SQL, views it reads)
DERIVED = {
    "clean": (_clean("files"), ["files"]),
    "summary": (SUMMARY, ["clean"]),
    "coverage": (COVERAGE, ["summary", "reports", "artifacts"]),
    "inventory": (INVENTORY, ["sites"]),
    "latest": (LATEST, ["files"]),
    "dups": (DUPS, ["clean"]),
    "flagged": (_flagged("site_url"), ["clean"]),
    "dims": (_dims("site_url"), ["clean", "sites", "accounts"]),
    "indexed": (f"SELECT *, {_index()} AS health FROM dims", ["dims"]),
}


def duckdb_sql(sql: str, views: tuple[str, ...], overrides: dict[str, str] | None = None) -> str:
    """The query with the views it reads as common table expressions."""
    derived: dict[str, None] = {}
    base: list[str] = []

    def need(name: str) -> None:
        if name not in DERIVED:
            base.append(name)
            return
        for below in DERIVED[name][1]:
            need(below)
        derived[name] = None

    for view in views:
        need(view)
    body = {**{n: DERIVED[n][0] for n in derived}, **(overrides or {})}
    ctes = [fixtures.duckdb_ctes(base)] if base else []
    ctes += [f"{name} AS ({body[name]})" for name in derived]
    return f"WITH {', '.join(ctes)}\n{sql.strip()}"


# --- sources and sinks ---------------------------------------------------------

RAW_COLUMNS = [
    "site", "site_url", "library", "folder", "file_name", "path", "size_bytes", "modified_ts",
    "created_ts", "created_by", "modified_by", "checked_out",
]


def _survey_layout(raw: DataFrame, names: list[str]) -> DataFrame:
    theirs = {ours: name for name, ours in SURVEY_COLUMNS.items()}
    return raw.select(*[F.col(n).alias(theirs[n]) for n in names])


#: Surveys as they are kept: every value quoted, packed.
SURVEY_CSV = {"header": True, "quoteAll": True, "escape": '"', "compression": "gzip"}


def _write_surveys(e: Estate) -> str:
    """The raw files as survey CSVs of two layouts that differ in column order."""
    folder = e.folder("surveys")
    raw = e.table("files_raw")
    halves = {
        "North_20011101_080000": (F.col("checked_out") == "No", RAW_COLUMNS),
        "Resumen_20011102_080000": (F.col("checked_out") != "No", RAW_COLUMNS[::-1]),
    }
    for name, (rows, columns) in halves.items():
        _survey_layout(raw.where(rows), columns).write.options(**SURVEY_CSV).csv(
            f"{folder}/Client_B_Docs_{name}.csv"
        )
    return folder


@query("SELECT * FROM files_raw", ("files_raw",))
def i1_read_surveys(e):
    return surveys.read_surveys(e.spark, _write_surveys(e), "Client").select(*RAW_COLUMNS)


@query(
    """SELECT site_url, path, size_bytes, modified_ts,
  CASE WHEN library IS NULL THEN NULL ELSE checked_out END AS checked_out FROM files_raw""",
    ("files_raw",),
)
def i2_union_surveys(e):
    raw = e.table("files_raw")
    new = raw.where("library IS NOT NULL").select(
        "checked_out", "path", "site_url", "size_bytes", "modified_ts"
    )
    old = raw.where("library IS NULL").select("site_url", "path", "modified_ts", "size_bytes")
    return surveys.union_surveys([new, old]).select(
        "site_url", "path", "size_bytes", "modified_ts", "checked_out"
    )


@query(
    """SELECT CASE WHEN size_bytes = 'n/a' THEN 'bad' ELSE 'good' END AS status, count(*) AS n
FROM files_raw GROUP BY ALL""",
    ("files_raw",),
)
def i3_quarantine(e):
    """Rows with an unreadable size are written with a field too many."""
    folder = e.folder("surveys-bad")
    cells = [F.concat(F.lit('"'), F.coalesce(name, F.lit("")), F.lit('"')) for name in RAW_COLUMNS]
    extra = F.when(F.col("size_bytes") == "n/a", F.lit(',"extra"')).otherwise(F.lit(""))
    header = ",".join(_survey_layout(e.table("files_raw"), RAW_COLUMNS).columns)
    lines = e.table("files_raw").select(F.concat(F.concat_ws(",", *cells), extra).alias(header))
    lines.write.options(header=True, quote="", sep="\t", compression="gzip").csv(
        f"{folder}/Client_B_Docs_East_20011103_080000.csv"
    )
    good, bad = surveys.quarantine(surveys.read_surveys(e.spark, folder))
    status = good.select("path", F.lit("good").alias("status")).unionByName(
        bad.select(F.col("line").alias("path"), F.lit("bad").alias("status"))
    )
    return status.groupBy("status").agg(F.count("path").alias("n"))


def _write_lines(frame: DataFrame, header: str, folder: str, name: str) -> None:
    """A survey whose lines are given as they are."""
    lines = frame.toDF(header).coalesce(1)
    lines.write.options(header=True, quote="", sep="\t").csv(f"{folder}/Client_B_Docs_{name}.csv")


def _write_runs(e: Estate) -> str:
    """Two runs over the same files, one with a line that does not fit, and a file that is no survey."""
    folder = e.folder("surveys-runs")
    raw = e.table("files_raw")
    for name, rows in {
        "North_20011101_080000": raw,
        "North_20011102_080000": raw.where("library IS NOT NULL"),
    }.items():
        _survey_layout(rows, RAW_COLUMNS).write.options(**SURVEY_CSV).csv(
            f"{folder}/Client_B_Docs_{name}.csv"
        )
    names = _survey_layout(raw, RAW_COLUMNS).columns
    one = e.table("sites").orderBy("site_url").limit(1)
    _write_lines(one.select(F.lit('"too","few"')), ",".join(names), folder, "South_20011103_080000")
    _write_lines(one.select(F.lit('"x"')), ",".join(names[2:]), folder, "West_20011103_080000")
    return folder


@query(
    f"""SELECT site_url, path, library, coalesce(try_cast(size_bytes AS BIGINT), 0) AS size_bytes,
  CASE v WHEN 1 THEN DATE '2001-11-01' ELSE DATE '2001-11-02' END AS survey_date FROM (
  SELECT * FROM (SELECT *, 1 AS v FROM files_raw UNION ALL SELECT *, 2 AS v FROM files_raw WHERE library IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY site_url, path ORDER BY v DESC, site DESC NULLS LAST, library DESC NULLS LAST,
    folder DESC NULLS LAST, file_name DESC NULLS LAST, size_bytes DESC NULLS LAST, created_ts DESC NULLS LAST,
    modified_ts DESC NULLS LAST, created_by DESC NULLS LAST, modified_by DESC NULLS LAST, checked_out DESC NULLS LAST) = 1)
WHERE {KEPT_LIBRARY} AND {KEPT_FILE}
UNION ALL SELECT '(row)', '"too","few"', NULL, 0, NULL
UNION ALL SELECT '(file)', 'missing columns: Sitio, URL_Sitio', NULL, 0, NULL""",
    ("files_raw",),
)
def i1_ingest(e):
    """From survey files to clean files, landed by date and read back, with what was left out."""
    files, rows, bad = surveys.ingest(e.spark, _write_runs(e), PARAMS, "Client")
    out = e.folder("ingested")
    for _ in range(2):  # landing again changes nothing
        sinks.write_files(files, out)
    names = ["site_url", "path", "library", "size_bytes", "survey_date"]
    left_out = rows.select(F.lit("(row)").alias("site_url"), F.col("line").alias("path")).unionByName(
        bad.select(F.lit("(file)").alias("site_url"), F.col("problem").alias("path"))
    )
    left_out = left_out.select(
        "site_url", "path", F.lit(None).cast("string").alias("library"),
        F.lit(0).cast("bigint").alias("size_bytes"), F.lit(None).cast("date").alias("survey_date"),
    )
    return e.spark.read.parquet(out).select(*names).unionByName(left_out)


@query("SELECT 'missing columns: Sitio, URL_Sitio' AS problem, 1 AS n", ("sites",))
def i3_bad_files(e):
    bad = surveys.bad_files(e.spark, _write_runs(e), "Client")
    return bad.groupBy("problem").agg(F.count("path").cast("int").alias("n"))


@query(
    """SELECT 'missing columns: Sitio, URL_Sitio' AS problem, 1::BIGINT AS n UNION ALL SELECT 'empty file', 2
UNION ALL SELECT 'line', 1 UNION ALL SELECT 'none', (SELECT count(*) + count(library) FROM files_raw)""",
    ("files_raw",),
)
def i3_bad_files_and_rows(e):
    """A folder with empty files too, read twice with one manifest: what is of no use, and how many rows are left."""
    folder, known = _write_runs(e), e.folder("manifest")
    at = e.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = at.getFileSystem(e.spark.sparkContext._jsc.hadoopConfiguration())
    for name in ("Empty_20011103_080000", "Void_20011104_080000"):
        files.create(at.suffix(f"/Client_B_Docs_{name}.csv")).close()
    surveys.survey_files(e.spark, folder, "Client", known)
    good, lines = surveys.quarantine(surveys.read_surveys(e.spark, folder, "Client", known))
    bad = surveys.bad_files(e.spark, folder, "Client", known).select("problem")
    every = bad.unionByName(lines.select(F.lit("line").alias("problem"))).unionByName(good.select(F.lit("none").alias("problem")))
    return every.groupBy("problem").agg(F.count("*").alias("n"))


@query(
    """SELECT count(*) AS n, count(*) FILTER (WHERE size_bytes IS NOT NULL AND try_cast(size_bytes AS BIGINT) IS NULL) AS bad_size,
  count(*) FILTER (WHERE size_bytes IS NULL) AS no_size,
  count(*) FILTER (WHERE modified_ts = '31/12/1999') AS bad_time FROM files_raw""",
    ("files_raw",),
)
def i3_reject_counts(e):
    return surveys.reject_counts(e.table("files_raw"))


@query(
    "SELECT * FROM inventory_runs WHERE run_ts = (SELECT max(run_ts) FROM inventory_runs)",
    ("inventory_runs",),
)
def i4_latest_inventory(e):
    return inventory_runs.latest_inventory(e.table("inventory_runs"))


def _as_csv(rows: DataFrame, columns: dict[str, str], path: str) -> None:
    """Rows as the scripts write them: their names, days, Sí and No, empty for NULL."""
    plain = {"timestamp_ntz": lambda x: F.date_format(x, "yyyy-MM-dd"), "boolean": lambda x: F.when(x, c.YES).otherwise("No")}
    kinds = dict(rows.dtypes)
    cells = []
    for theirs, ours in columns.items():
        value = F.col(ours) if ours in kinds else F.lit("")
        cells.append(plain.get(kinds.get(ours), lambda x: x.cast("string"))(value).alias(theirs))
    rows.select(*cells).write.options(header=True, quoteAll=True, escape='"').csv(path)


@query(
    """SELECT site, site_url, site_class, site_type, template, is_hub, hub_id, storage_gb, storage_mb, owner,
  sharing, lock_state, last_activity_ts, TIMESTAMP '2001-11-04 08:00:00' AS run_ts FROM inventory""",
    ("inventory",),
)
def i4_read_inventory(e):
    """Two inventories of a client whose name has a space; the newest one's sites."""
    folder = e.folder("inventories")
    for stamp, rows in {"20011101_080000": e.inventory.where("is_hub"), "20011104_080000": e.inventory}.items():
        _as_csv(rows, INVENTORY_COLUMNS, f"{folder}/My_Client_A_Inventario_Sitios_{stamp}.csv")
    runs = inventory_runs.read_inventory(e.spark, folder, "My Client")
    return inventory_runs.latest_inventory(runs).drop("has_group", "created_ts", "survey_flag")


@query(
    f"""SELECT site, site_url, library, path, folder, file_name, ext, {CATEGORY} AS category, size_bytes,
  round_even(size_bytes / 1024e0, 1) AS size_kb, round_even(size_bytes / 1048576e0, 2) AS size_mb,
  created_ts, modified_ts, created_by, modified_by, (survey_no + 1) || '.0' AS version,
  checked_out AND modified_by IS NOT NULL AS checked_out,
  CAST(len(string_split(folder, '/')) AS INTEGER) AS depth
FROM (SELECT *, {EXT} AS ext FROM files) WHERE size_bytes <> 0""",
    ("files",),
)
def i5_normalize_listing(e):
    return listing.normalize_listing(e.table("listing"))


@query("SELECT *, CAST(TIMESTAMP '2001-11-01' + INTERVAL '1' DAY * survey_no AS DATE) AS survey_date FROM files", ("files",))
def i6_write_files(e):
    out = e.folder("files")
    day = F.date_add(F.lit("2001-11-01").cast("date"), F.col("survey_no"))
    sinks.write_files(e.files.withColumn("survey_date", day), out)
    return e.spark.read.parquet(out)


@query(
    """SELECT site_url, path, survey_no, size_bytes, modified_ts FROM files
WHERE (site_url, path) = (SELECT (site_url, min(path)) FROM files WHERE site_url = (SELECT min(site_url) FROM files) GROUP BY site_url)""",
    ("files",),
)
def i6_file_history(e):
    """The landed rows of one file of all dates: the first by path of the first site."""
    out = e.folder("files")
    day = F.date_add(F.lit("2001-11-01").cast("date"), F.col("survey_no"))
    sinks.write_files(e.files.withColumn("survey_date", day), out)
    site_url = e.files.agg(F.min("site_url")).first()[0]
    path = sinks.read_files(e.spark, out, site_url).agg(F.min("path")).first()[0]
    found = sinks.read_files(e.spark, out, site_url, path)
    return found.select("site_url", "path", "survey_no", "size_bytes", "modified_ts")


@query(
    f"""SELECT site_url, files, {REC} AS recommendation, n_dup_groups FROM summary
LEFT JOIN (SELECT site_url, least(count(*), 15) AS n_dup_groups FROM dups GROUP BY ALL
  HAVING sum(extra_bytes) / 1e9 > 0.01) d USING (site_url)""",
    ("summary", "dups"),
)
def i7_write_reports(e):
    out = e.folder("reports")
    sinks.write_reports(_landed_report(e), {"summary": e.summary}, out)
    sites = e.spark.read.json(f"{out}/sites").select(
        "site_url", F.nullif(F.size("top_duplicates"), F.lit(0)).alias("n_dup_groups")
    )
    summary = e.spark.read.parquet(f"{out}/summary")
    return summary.join(sites, "site_url").select(
        "site_url", "files", "recommendation", F.col("n_dup_groups").cast("bigint").alias("n_dup_groups")
    )


# --- cleaning ------------------------------------------------------------------

ROW = ["site_url", "path", "survey_no", "size_bytes", "modified_ts"]
ROW_SQL = ", ".join(ROW)


@query(f"SELECT {ROW_SQL}, library FROM files WHERE {KEPT_LIBRARY}", ("files",))
def c1_drop_system_libraries(e):
    return clean.drop_system_libraries(e.files).select(*ROW, "library")


@query(f"SELECT {ROW_SQL}, file_name FROM files WHERE {KEPT_FILE}", ("files",))
def c2_drop_system_files(e):
    return clean.drop_system_files(e.files).select(*ROW, "file_name")


TIME = "coalesce(try_strptime({0}, '%Y-%m-%d %H:%M'), try_strptime({0}, '%Y-%m-%d'))"


@query(
    f"""SELECT site_url, path, {TIME.format('created_ts')} AS created_ts,
  {TIME.format('modified_ts')} AS modified_ts FROM files_raw""",
    ("files_raw",),
)
def c3_parse_times(e):
    return clean.parse_times(e.table("files_raw")).select(
        "site_url", "path", "created_ts", "modified_ts"
    )


@query(
    "SELECT site_url, path, coalesce(try_cast(size_bytes AS BIGINT), 0) AS size_bytes FROM files_raw",
    ("files_raw",),
)
def c4_coerce_numbers(e):
    return clean.coerce_numbers(e.table("files_raw")).select("site_url", "path", "size_bytes")


@query(f"SELECT {ROW_SQL}, {POST} AS is_post FROM files", ("files",))
def c5_flag_post(e):
    return clean.flag_post(e.files, PARAMS.migrated_at).select(*ROW, "is_post")


@query(f"SELECT {ROW_SQL}, {INACTIVE} AS is_inactive FROM files", ("files",))
def c6_flag_inactive(e):
    return clean.flag_inactive(e.files, PARAMS.migrated_at, 2).select(*ROW, "is_inactive")


@query(
    "SELECT site_url, path, coalesce(checked_out = 'Sí', false) AS checked_out FROM files_raw",
    ("files_raw",),
)
def c7_parse_checkout(e):
    return clean.parse_checkout(e.table("files_raw")).select("site_url", "path", "checked_out")


@query(
    f"""SELECT *, {POST} AS is_post, {INACTIVE} AS is_inactive FROM (
  SELECT site, site_url, library, folder, file_name, path,
    coalesce(try_cast(size_bytes AS BIGINT), 0) AS size_bytes,
    {TIME.format('modified_ts')} AS modified_ts, {TIME.format('created_ts')} AS created_ts,
    created_by, modified_by, checked_out = 'Sí' AS checked_out, 0 AS depth
  FROM files_raw WHERE {KEPT_LIBRARY} AND {KEPT_FILE})""",
    ("files_raw",),
)
def c8_clean(e):
    return clean.clean(e.table("files_raw"), PARAMS)


@query(f"SELECT {ROW_SQL}, ext, {CATEGORY} AS category FROM (SELECT *, {EXT} AS ext FROM files)", ("files",))
def c9_categorize(e):
    typed = e.files.withColumn("ext", text.file_ext(F.col("file_name")))
    return clean.categorize(typed).select(*ROW, "ext", "category")


SPECIAL_VALUES = ", ".join(
    f"('{ext}', '{label}', '{note}')" for ext, (label, note) in c.SPECIAL_FORMATS.items()
)


@query(
    f"""SELECT {ROW_SQL}, ext, label, note FROM clean
JOIN (VALUES {SPECIAL_VALUES}) s(ext, label, note) USING (ext)"""
)
def c10_special_formats(e):
    return clean.special_formats(e.clean).select(*ROW, "ext", "label", "note")


@query(
    f"""SELECT {ROW_SQL}, {REL} AS rel_path, substr({REL}, 1, length({REL}) - length(file_name) - 1) AS folder,
  CAST(len(string_split({REL}, '/')) - 1 AS INTEGER) AS depth FROM files""",
    ("files",),
)
def c11_relative_path(e):
    return clean.relative_path(e.files).select(*ROW, "rel_path", "folder", "depth")


@query(f"SELECT {ROW_SQL}, folder, {TOP_FOLDER} AS top_folder FROM files", ("files",))
def c12_top_folder(e):
    return clean.top_folder(e.files).select(*ROW, "folder", "top_folder")


@query(
    f"""SELECT {ROW_SQL}, round_even(size_bytes / 1024e0, 1) AS size_kb,
  round_even(size_bytes / 1048576e0, 2) AS size_mb FROM files""",
    ("files",),
)
def c13_size_units(e):
    return clean.size_units(e.files).select(*ROW, "size_kb", "size_mb")


@query(
    """SELECT DISTINCT site, substr(regexp_replace(regexp_replace(site, '[^a-zA-Z0-9_-]', '_', 'g'), '_+', '_', 'g'), 1, 12) AS slug
FROM files""",
    ("files",),
)
def c14_site_slug(e):
    return clean.site_slug(e.files, 12).select("site", "slug").distinct()


@query(f"SELECT site, {ROW_SQL} FROM files WHERE contains(lower(site), 'r#00000001')", ("files",))
def c15_site_filter(e):
    return clean.site_filter(e.files, "R#00000001").select("site", *ROW)


# --- site inventory --------------------------------------------------------------

SITE_ROW = ["site", "site_url"]


@query(f"SELECT site, site_url, template, {SITE_TYPE} AS site_type FROM sites", ("sites",))
def n1_site_type(e):
    return inventory.site_type(e.sites).select(*SITE_ROW, "template", "site_type")


@query(f"SELECT site, site_url, {_site_class()} AS site_class FROM sites", ("sites",))
def n2_site_class(e):
    return inventory.site_class(e.sites).select(*SITE_ROW, "site_class")


@query(
    f"SELECT site, site_url, {_site_class(LISTS.root_url, LISTS.legacy_prefixes[0])} AS site_class FROM sites",
    ("sites",),
)
def n2_site_class_with_lists(e):
    classed = inventory.site_class(e.sites, LISTS.root_url, LISTS.legacy_prefixes)
    return classed.select(*SITE_ROW, "site_class")


@query("SELECT * FROM inventory", ("inventory",))
def n3_site_columns(e):
    return e.inventory


@query(
    f"""SELECT i.*, group_id IS NOT NULL AND group_id <> '{c.NO_ID}' AS has_group, CAST(NULL AS VARCHAR) AS survey_flag,
  created_ts FROM inventory i JOIN (SELECT site_url, group_id, created_ts FROM grouped_sites) USING (site_url)""",
    ("inventory", "grouped_sites"),
)
def n3_site_columns_of_groups(e):
    typed = inventory.site_class(inventory.site_type(e.table("grouped_sites")))
    return inventory.site_columns(typed).drop("group_id")


@query(
    f"""SELECT site, site_url, site_class, site_type, template, is_hub, lock_state, last_activity_ts, storage_gb, owner
FROM inventory UNION ALL
SELECT s.site, s.site_url, '{c.SUBSITE_CLASS}', '{c.SUBSITE_TYPE_PREFIX}' || p.site, s.template, false, 'No',
  s.last_activity_ts, NULL, NULL FROM subsites s JOIN inventory p ON p.site_url = s.parent_url""",
    ("inventory", "subsites"),
)
def n4_add_subsites(e):
    return inventory.add_subsites(e.inventory, e.table("subsites")).select(
        *SITE_ROW, "site_class", "site_type", "template", "is_hub", "lock_state",
        "last_activity_ts", "storage_gb", "owner",
    )


@query(
    f"""SELECT site_url, site_class, storage_gb FROM inventory UNION ALL
SELECT site_url, '{c.SUBSITE_CLASS}', NULL FROM subsites ORDER BY site_class, storage_gb DESC NULLS LAST""",
    ("inventory", "subsites"),
)
def n5_inventory_order(e):
    every = inventory.add_subsites(e.inventory, e.table("subsites"))
    return inventory.inventory_order(every).select("site_url", "site_class", "storage_gb")


@query(
    f"""SELECT site_class, count(*) AS n_sites FROM (SELECT site_class FROM inventory UNION ALL
SELECT '{c.SUBSITE_CLASS}' FROM subsites) GROUP BY ALL""",
    ("inventory", "subsites"),
)
def n6_class_counts(e):
    return inventory.class_counts(inventory.add_subsites(e.inventory, e.table("subsites")))


@query(
    """SELECT (SELECT count(*) FROM inventory) AS n_sites, (SELECT count(*) FROM subsites) AS n_subsites,
  (SELECT CAST(sum(CAST(storage_gb AS DECIMAL(18, 2))) AS DOUBLE) FROM inventory) AS storage_gb""",
    ("inventory", "subsites"),
)
def n7_inventory_totals(e):
    return inventory.inventory_totals(inventory.add_subsites(e.inventory, e.table("subsites")))


LEGACY = (
    "(regexp_matches(upper(template), '^(GROUP|TEAMCHANNEL)#[01]') "
    f"OR starts_with(lower(site), '{LISTS.legacy_prefixes[0]}'))"
)
OPEN = (
    "lock_state <> 'ReadOnly' AND NOT (site_type = 'Canal de Teams' AND "
    f"starts_with(lower(site), '{LISTS.channel_prefixes[0].lower()}'))"
)
NOT_LISTED = "NOT contains(site_url, 'sites/s1') AND NOT contains(site_url, 'sites/s77')"


@query(f"SELECT site, site_url, template, {LEGACY} AS is_legacy FROM sites", ("sites",))
def n8_is_legacy(e):
    marked = inventory.is_legacy(e.sites, LISTS.legacy_templates, LISTS.legacy_prefixes)
    return marked.select(*SITE_ROW, "template", "is_legacy")


@query(
    f"SELECT site, site_url, lock_state, site_type FROM inventory WHERE {OPEN} AND {NOT_LISTED}",
    ("inventory",),
)
def n9_exclude_sites(e):
    kept = inventory.exclude_sites(e.inventory, LISTS.excluded_ids, LISTS.channel_prefixes)
    return kept.select(*SITE_ROW, "lock_state", "site_type")


BACKLOG = f"""SELECT site, site_url, storage_gb FROM inventory
WHERE {LEGACY} AND {OPEN} AND {NOT_LISTED} AND storage_gb > 0"""


def _backlog(e: Estate) -> DataFrame:
    """Storage as an inventory file may spell it, with a decimal comma."""
    comma = F.replace(F.col("storage_gb").cast("string"), F.lit("."), F.lit(","))
    return inventory.survey_backlog(e.inventory.withColumn("storage_gb", comma), LISTS)


@query(BACKLOG, ("inventory",))
def n10_survey_backlog(e):
    return _backlog(e).select(*SITE_ROW, "storage_gb")


@query(
    f"""SELECT count(*) AS n_sites, round_even(CAST(sum(CAST(storage_gb AS DECIMAL(18, 2))) AS DOUBLE), 1) AS storage_gb
FROM ({BACKLOG})""",
    ("inventory",),
)
def n11_backlog_totals(e):
    return inventory.backlog_totals(_backlog(e))


@query(
    "SELECT site, site_url, site_class FROM inventory WHERE site_url = 'https://tenant.example/sites/s7'",
    ("inventory",),
)
def n12_single_site(e):
    found = inventory.single_site(e.inventory, "https://tenant.example/Sites/S7")
    return found.select(*SITE_ROW, "site_class")


# --- refresh ---------------------------------------------------------------------

LAST = "SELECT site_url, max(surveyed_ts) AS surveyed_ts FROM surveys WHERE status = 'OK' GROUP BY ALL"
REASON = """CASE WHEN surveyed_ts IS NULL THEN 'never' WHEN last_activity_ts > surveyed_ts THEN 'newer'
  WHEN last_activity_ts >= TIMESTAMP '2001-10-29' THEN 'recent' ELSE 'current' END"""
PLAN = f"""SELECT site_url, surveyed_ts, storage_gb, {REASON} AS reason, {REASON} <> 'current' AS run
FROM inventory LEFT JOIN ({LAST}) USING (site_url)
WHERE site_class = '{c.LEGACY_LABEL}' AND {OPEN} AND storage_gb > 0"""


@query(LAST, ("surveys",))
def r1_last_survey(e):
    return refresh.last_survey(e.table("surveys"))


@query(
    f"SELECT site_url, surveyed_ts, {REASON} AS reason FROM sites LEFT JOIN ({LAST}) USING (site_url)",
    ("sites", "surveys"),
)
def r2_refresh_reason(e):
    reasons = refresh.refresh_reason(e.sites, e.table("surveys"), PARAMS.as_of, PARAMS.refresh_days)
    return reasons.select("site_url", "surveyed_ts", "reason")


def _plan(e: Estate, days: int | None = None) -> DataFrame:
    return refresh.refresh_plan(e.inventory, e.table("surveys"), LISTS, days)


@query(PLAN, ("inventory", "surveys"))
def r2_refresh_plan(e):
    return _plan(e).select("site_url", "surveyed_ts", "storage_gb", "reason", "run")


@query(
    f"""SELECT site_url, CASE WHEN surveyed_ts IS NULL THEN 'never' ELSE 'forced' END AS reason, true AS run
FROM ({PLAN})""",
    ("inventory", "surveys"),
)
def r2_refresh_plan_forced(e):
    return _plan(e, 999).select("site_url", "reason", "run")


@query(
    f"""SELECT run, reason, count(*) AS n_sites,
  CAST(sum(CAST(storage_gb AS DECIMAL(18, 2))) AS DOUBLE) AS storage_gb FROM ({PLAN}) GROUP BY ALL""",
    ("inventory", "surveys"),
)
def r3_plan_totals(e):
    return refresh.plan_totals(_plan(e))


@query(
    "SELECT site, site_url FROM sites WHERE site_url NOT IN (SELECT site_url FROM surveys WHERE status = 'OK')",
    ("sites", "surveys"),
)
def r4_pending(e):
    return refresh.pending(e.sites, e.table("surveys")).select(*SITE_ROW)


RUNS = """SELECT s.*, coalesce(n, 0) AS files, CAST(substr(site_url, 31) AS BIGINT) AS run_order FROM surveys s
LEFT JOIN (SELECT site_url, count(*) AS n FROM files GROUP BY ALL) USING (site_url)"""


def _runs(e: Estate) -> DataFrame:
    counts = refresh.survey_rows(e.files, e.sites).select("site_url", "files")
    order = F.substring("site_url", 31, 20).cast("bigint")
    return e.table("surveys").join(counts, "site_url").withColumn("run_order", order)


@query(
    f"""SELECT count(*) FILTER (WHERE status = 'OK') AS n_ok, count(*) FILTER (WHERE status = 'Salteado') AS n_skipped,
  count(*) FILTER (WHERE status IN ('SinArchivos', 'SinBibliotecas')) AS n_empty,
  count(*) FILTER (WHERE status LIKE 'Error%') AS n_error,
  CAST(sum(files) FILTER (WHERE status = 'OK') AS BIGINT) AS files FROM ({RUNS})""",
    ("surveys", "files"),
)
def r5_run_summary(e):
    return refresh.run_summary(_runs(e))


@query(
    f"""SELECT run_order, site_url, status, files, TIMESTAMP '2001-11-05 12:00:00' AS surveyed_ts FROM ({RUNS})""",
    ("surveys", "files"),
)
def r5_read_runs(e):
    folder = e.folder("runs")
    _as_csv(_runs(e), RUN_COLUMNS, f"{folder}/Client_B_Masivo_Resumen_20011105_120000.csv")
    runs = inventory_runs.read_runs(e.spark, folder, "Client")
    return runs.select("run_order", "site_url", "status", "files", "surveyed_ts")


def _cut_lines(rows: DataFrame, columns: dict[str, str], cut, path: str) -> None:
    """Rows as the scripts write them; where `cut` holds, the line ends after its second field."""
    cells = [F.concat(F.lit('"'), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"')) if c in rows.columns else F.lit('""') for c in columns.values()]
    whole = F.concat_ws(",", *cells)
    line = F.when(cut, F.concat_ws(",", *cells[:2])).otherwise(whole)
    header = ",".join(f'"{name}"' for name in columns)
    rows.select(line.alias(header)).write.options(header=True, quote="", sep="\t").csv(path)


@query(
    f"""SELECT 'run' AS kind, CASE WHEN status LIKE 'Error%' THEN 'left out' ELSE 'read' END AS state, count(*) AS n, sum(run_order)::BIGINT AS orders
FROM ({RUNS}) GROUP BY ALL
UNION ALL SELECT 'inventory', CASE WHEN is_hub THEN 'left out' ELSE 'read' END, count(*), NULL FROM inventory GROUP BY ALL""",
    ("surveys", "files", "inventory"),
)
def r5_bad_lines(e):
    """Run summaries and inventories some of whose lines are cut: read are the others, and all cut lines are handed back."""
    folder = e.folder("cut")
    _cut_lines(_runs(e), RUN_COLUMNS, F.col("status").startswith("Error"), f"{folder}/Client_B_Masivo_Resumen_20011105_120000.csv")
    _cut_lines(e.inventory, INVENTORY_COLUMNS, F.col("is_hub"), f"{folder}/Client_A_Inventario_Sitios_20011104_080000.csv")
    runs = inventory_runs.read_runs(e.spark, folder, "Client").select(F.lit("run").alias("kind"), F.lit("read").alias("state"), F.col("run_order").alias("o"))
    sites = inventory_runs.read_inventory(e.spark, folder, "Client")
    sites = sites.select(F.lit("inventory").alias("kind"), F.lit("read").alias("state"), F.lit(None).cast("bigint").alias("o"))
    bad = inventory_runs.bad_lines(e.spark, folder, "Client")
    first = F.regexp_extract("line", '^"([0-9]*)"', 1)  # a run's line starts with its number
    order = F.when(F.col("kind") == "run", first.try_cast("bigint"))
    bad = bad.select("kind", F.lit("left out").alias("state"), order.alias("o"))
    every = runs.unionByName(sites).unionByName(bad)
    return every.groupBy("kind", "state").agg(F.count("*").alias("n"), F.sum("o").alias("orders"))


@query(
    f"SELECT site_url, status, run_order, files FROM ({RUNS}) WHERE status LIKE 'Error%'",
    ("surveys", "files"),
)
def r6_failed_sites(e):
    return refresh.failed_sites(_runs(e)).select("site_url", "status", "run_order", "files")


@query("SELECT * FROM latest", ("latest",))
def r7_latest_snapshot(e):
    return refresh.latest_snapshot(e.files)


@query(
    """SELECT * FROM latest WHERE (site_url, survey_no) IN
  (SELECT (site_url, max(survey_no)) FROM files GROUP BY site_url)""",
    ("latest", "files"),
)
def r7_latest_snapshot_without_missing(e):
    return refresh.latest_snapshot(e.files, drop_missing=True)


@query(
    f"""SELECT l.* FROM latest l LEFT JOIN (SELECT site_url, max(survey_no) AS ended FROM runs
  WHERE status = '{c.OK}' GROUP BY ALL) USING (site_url) WHERE ended IS NULL OR survey_no >= ended""",
    ("latest", "runs"),
)
def r7_latest_snapshot_of_ok_runs(e):
    return refresh.latest_snapshot(e.files, drop_missing=True, runs=e.table("runs"))


@query(
    """SELECT site_url, coalesce(libraries, 0) AS libraries, coalesce(files, 0) AS files,
  CASE WHEN files > 0 THEN 'OK' ELSE 'SinArchivos' END AS status
FROM visited_sites LEFT JOIN (SELECT site_url, count(DISTINCT library) AS libraries, count(*) AS files
  FROM files GROUP BY ALL) USING (site_url)""",
    ("visited_sites", "files"),
)
def r8_survey_rows(e):
    """Subsites were visited too and have no files."""
    return refresh.survey_rows(e.files, e.table("visited_sites"))


# --- whole estate ----------------------------------------------------------------


@query(
    """SELECT count(*) AS files, sum(size_bytes)::DOUBLE / 1e9 AS gb, count(DISTINCT site) AS sites,
  count(*) FILTER (WHERE is_post) AS post, (count(*) FILTER (WHERE is_post))::DOUBLE / count(*) * 100 AS pct_post,
  count(*) FILTER (WHERE is_inactive) AS inactive, count(*) FILTER (WHERE checked_out) AS checked_out,
  count(DISTINCT modified_by) AS users FROM clean"""
)
def t1_corpus_totals(e):
    return tenant.corpus_totals(e.clean)


@query("SELECT * FROM summary", ("summary",))
def t2_site_summary(e):
    return e.summary


@query("SELECT site, site_url, top_category FROM summary", ("summary",))
def t3_top_category(e):
    return tenant.top_category(e.clean)


@query("SELECT site_url, post, files, recommendation FROM summary", ("summary",))
def t4_recommend(e):
    bare = e.clean.groupBy("site_url").agg(F.count_if("is_post").alias("post"), F.count("*").alias("files"))
    return tenant.recommend(bare)


@query(
    "SELECT recommendation, count(*) AS n_sites, sum(bytes)::DOUBLE / 1e9 AS gb FROM summary GROUP BY ALL",
    ("summary",),
)
def t5_recommendation_counts(e):
    return tenant.recommendation_counts(e.summary)


@query(
    f"""SELECT site_url, gb, files, users, last_modified,
  bytes::DOUBLE / max(bytes) OVER () * 100 AS width FROM summary WHERE recommendation = '{c.ARCHIVE}'""",
    ("summary",),
)
def t6_archive_candidates(e):
    found = tenant.archive_candidates(e.summary)
    return found.select("site_url", "gb", "files", "users", "last_modified", "width")


@query(
    """SELECT category, count(*) AS files, sum(size_bytes)::DOUBLE / 1e9 AS gb,
  count(*)::DOUBLE / (SELECT count(*) FROM clean) * 100 AS pct_files,
  sum(size_bytes)::DOUBLE / (SELECT sum(size_bytes) FROM clean)::DOUBLE * 100 AS pct_gb FROM clean GROUP BY ALL"""
)
def t7_category_stats(e):
    return tenant.category_stats(e.clean)


@query(
    """SELECT modified_by, count(*) AS files, round_even(sum(size_bytes)::DOUBLE / 1e9, 2) AS gb,
  count(DISTINCT site) AS sites, count(*) FILTER (WHERE is_post) AS post, max(modified_ts) AS last_modified,
  CAST(row_number() OVER (ORDER BY count(*) DESC, modified_by) AS INTEGER) AS rank
FROM clean WHERE modified_by IS NOT NULL GROUP BY modified_by QUALIFY rank <= 30"""
)
def t8_top_users(e):
    return tenant.top_users(e.clean)


LISTED = ", ".join(tenant.FILE_LISTING)
BY_LISTED = ", ".join(f"{name} NULLS FIRST" for name in tenant.FILE_LISTING)


@query(
    f"""SELECT {LISTED}, CAST(row_number() OVER (ORDER BY site, modified_ts DESC, {BY_LISTED}) AS INTEGER) AS rank
FROM clean WHERE is_post QUALIFY rank <= 300"""
)
def t9_post_sample(e):
    return tenant.post_sample(e.clean)


@query(
    f"""SELECT {LISTED}, CAST(row_number() OVER (ORDER BY modified_ts, {BY_LISTED}) AS INTEGER) AS rank,
  count(*) OVER () AS total FROM clean WHERE is_inactive QUALIFY rank <= 150"""
)
def t10_inactive_files(e):
    return tenant.inactive_files(e.clean)


@query(f"SELECT {LISTED} FROM clean WHERE checked_out")
def t11_checked_out_files(e):
    return tenant.checked_out_files(e.clean)


@query(
    """SELECT site, site_url, gb, files, recommendation, CAST(NULL AS VARCHAR) AS target_hub,
  CAST(NULL AS VARCHAR) AS subfolder, CAST(NULL AS VARCHAR) AS responsible FROM summary""",
    ("summary",),
)
def t12_target_matrix(e):
    return tenant.target_matrix(e.summary)


@query(
    """SELECT site_url, pct_post, CASE WHEN post * 100 >= files * 30 THEN 'ok' WHEN post = 0 THEN 'critical'
  ELSE 'warning' END AS severity FROM summary""",
    ("summary",),
)
def t13_activity_colour(e):
    return tenant.activity_colour(e.summary).select("site_url", "pct_post", "severity")


# --- portfolio -------------------------------------------------------------------


@query(f"SELECT site_url, gb, {BAND} AS band FROM summary", ("summary",))
def x1_size_band(e):
    return portfolio.size_band(e.summary).select("site_url", "gb", "band")


@query(
    f"""SELECT {BAND} AS band, count(*) AS n_sites, sum(bytes)::DOUBLE / 1e9 AS gb,
  sum(bytes)::DOUBLE / (SELECT sum(bytes) FROM summary)::DOUBLE * 100 AS pct_gb FROM summary GROUP BY 1""",
    ("summary",),
)
def x2_band_totals(e):
    return portfolio.band_totals(e.summary)


@query("SELECT site_url, report, report_kind FROM coverage", ("coverage",))
def x3_report_coverage(e):
    return e.coverage.select("site_url", "report", "report_kind")


@query(
    f"""SELECT count(*) FILTER (WHERE report_kind IN ('{c.LISTED}', '{c.LISTED_MISSING}')) AS n_listed,
  count(*) FILTER (WHERE report_kind = '{c.GENERATED}') AS n_generated FROM coverage""",
    ("coverage",),
)
def x4_coverage_counts(e):
    return portfolio.coverage_counts(e.coverage)


@query(
    """SELECT ordinal, site_url, site, gb, destination, 'gold' AS state, artifact,
  artifact IN (SELECT artifact FROM artifacts) AS "exists" FROM reports LEFT JOIN summary USING (site_url)""",
    ("reports", "summary", "artifacts"),
)
def x5_priority_list(e):
    return portfolio.priority_list(e.table("reports"), e.summary, e.table("artifacts"))


PRIORITY = (("Supplier#000000003", "three.html", "hub-3"), ("nobody", "none.html", ""), ("Supplier#000000001", "one.html", "hub-1"))


@query(
    """SELECT * FROM (SELECT 0 AS ordinal, 'Supplier#000000003' AS site, 'three.html' AS artifact, 'hub-3' AS destination
  UNION ALL SELECT 2, 'Supplier#000000001', 'one.html', 'hub-1') JOIN (SELECT site, site_url FROM sites) USING (site)""",
    ("sites",),
)
def x5_priority_reports(e):
    listed = portfolio.priority_reports(e.sites, PARAMS.with_(priority_reports=PRIORITY))
    return listed.join(e.sites.select("site", "site_url"), "site_url")


@query(
    f"""SELECT {BAND} AS band, site, site_url, gb, files, pct_post, last_modified, recommendation, report_kind, report
FROM coverage WHERE NOT ({BAND} = 'main' AND coalesce(report_kind, '') LIKE 'prioritario%')""",
    ("coverage",),
)
def x6_band_listing(e):
    return portfolio.band_listing(e.coverage)


@query(
    f"SELECT 'mid' AS band, site_url, gb, report FROM coverage WHERE {BAND} = 'mid'", ("coverage",)
)
def x6_band_listing_of_one(e):
    return portfolio.band_listing(e.coverage, "mid").select("band", "site_url", "gb", "report")


@query(
    f"""SELECT site, site_url, gb, files, last_modified, {BAND} AS band, report_kind, report FROM coverage
WHERE recommendation = '{c.ARCHIVE}'""",
    ("coverage",),
)
def x7_archive_listing(e):
    return portfolio.archive_listing(e.coverage)


# --- per site --------------------------------------------------------------------

STATUS = (
    f"CASE WHEN post = 0 THEN '{c.STATUS_ARCHIVE}' WHEN post * 100 >= files * 30 THEN '{c.STATUS_ACTIVE}' "
    f"ELSE '{c.STATUS_LOW}' END"
)
PROFILE = """SELECT site_url, count(*) AS files, sum(size_bytes)::BIGINT AS bytes, sum(size_bytes)::DOUBLE / 1e9 AS gb,
  count(DISTINCT library) AS libraries, count(DISTINCT modified_by) AS users, max(depth) AS depth_max,
  round_even(sum(depth)::DOUBLE / count(*), 1) AS depth_mean, min(modified_ts) AS first_modified,
  max(modified_ts) AS last_modified, count(*) FILTER (WHERE is_post) AS post,
  (count(*) FILTER (WHERE is_post))::DOUBLE / count(*) * 100 AS pct_post,
  count(*) FILTER (WHERE is_inactive) AS inactive, count(*) FILTER (WHERE checked_out) AS checked_out
FROM clean GROUP BY site_url"""


def _breakdown(dim: str, where: str, source: str = "clean") -> str:
    """Counts per (site, value) beside the totals of the site."""
    return f"""(SELECT site_url, {dim}, count(*) AS files, sum(size_bytes)::BIGINT AS bytes,
    count(*) FILTER (WHERE is_post) AS post, max(modified_ts) AS last_modified
  FROM {source} WHERE {where} GROUP BY ALL) c
  JOIN (SELECT site_url, count(*) AS site_n, sum(size_bytes)::BIGINT AS site_bytes FROM clean GROUP BY ALL) s
  USING (site_url)"""


def _rank(order: str, k: int | None = None) -> str:
    rank = f"CAST(row_number() OVER (PARTITION BY site_url ORDER BY {order}) AS INTEGER)"
    return rank if k is None else f"{rank} AS rank"


@query(PROFILE)
def s1_site_profile(e):
    return site.site_profile(e.clean)


@query(f"SELECT site_url, {STATUS} AS status FROM ({PROFILE})")
def s2_site_status(e):
    return site.site_status(site.site_profile(e.clean)).select("site_url", "status")


@query(
    f"""SELECT site_url, category, files, bytes / 1e9 AS gb, files::DOUBLE / site_n * 100 AS pct_files,
  bytes::DOUBLE / site_bytes::DOUBLE * 100 AS pct_gb, {_rank('bytes DESC, category')} AS rank
FROM {_breakdown('category', 'true')}"""
)
def s3_site_categories(e):
    return site.site_categories(e.clean)


@query(
    f"""SELECT site_url, category, files::DOUBLE / site_n * 100 AS pct_files FROM {_breakdown('category', 'true')}
QUALIFY {_rank('bytes DESC, category')} = 1"""
)
def s4_dominant_category(e):
    return site.dominant_category(e.clean)


@query(
    f"""SELECT site_url, ext, files, bytes / 1e9 AS gb, bytes::DOUBLE / site_bytes::DOUBLE * 100 AS pct_gb,
  ext IN {_in(c.SPECIAL_FORMATS)} AS special, {_rank('bytes DESC, ext', 15)}
FROM {_breakdown('ext', "ext <> ''")} QUALIFY rank <= 15"""
)
def s5_site_extensions(e):
    return site.site_extensions(e.clean)


@query(
    f"""SELECT site_url, ext, label, note, files, bytes / 1e9 AS gb,
  bytes::DOUBLE / site_bytes::DOUBLE * 100 AS pct_gb,
  CASE WHEN ext IN ('heic', 'xlsm', 'xlsb') THEN 'Atención requerida'
    WHEN ext IN ('mp4', 'mov', 'avi') THEN 'Evaluar Azure Blob'
    WHEN ext IN ('zip', 'rar', '7z') AND bytes / 1e9 > 0.25 THEN 'Verificar límite SPMT' ELSE 'Revisar' END AS alert
FROM {_breakdown('ext', 'true')} JOIN (VALUES {SPECIAL_VALUES}) f(ext, label, note) USING (ext)"""
)
def s6_site_special_formats(e):
    return site.site_special_formats(e.clean)


SITE_LISTED = "site_url, " + ", ".join(site.LISTING)
BY_SITE_LISTED = ", ".join(f"{name} NULLS FIRST" for name in site.LISTING)


@query(
    f"""SELECT {SITE_LISTED}, size_bytes > 262144000 AS over_limit,
  {_rank(f'size_bytes DESC, {BY_SITE_LISTED}', 20)}
FROM clean WHERE size_bytes > 104857600 QUALIFY rank <= 20"""
)
def s7_large_files(e):
    return site.large_files(e.clean)


@query(f"SELECT {SITE_LISTED} FROM clean WHERE {BIG_ZIP}")
def s8_oversize_archives(e):
    return site.oversize_archives(e.clean)


@query("SELECT * FROM dups", ("dups",))
def s9_duplicates(e):
    return site.duplicates(e.clean)


@query(
    """SELECT site_url, (sum(copies) - count(*))::BIGINT AS extra_files, count(*) AS n_groups,
  sum(extra_bytes)::BIGINT AS extra_bytes, sum(extra_bytes)::DOUBLE / 1e9 AS extra_gb FROM dups GROUP BY ALL""",
    ("dups",),
)
def s10_duplicate_totals(e):
    return site.duplicate_totals(site.duplicates(e.clean))


@query(
    f"""SELECT *, {_rank('extra_bytes DESC, file_name, size_bytes', 15)} FROM dups
WHERE site_url IN (SELECT site_url FROM dups GROUP BY ALL HAVING sum(extra_bytes) / 1e9 > 0.01) QUALIFY rank <= 15""",
    ("dups",),
)
def s11_top_duplicates(e):
    return site.top_duplicates(site.duplicates(e.clean))


@query(
    f"""SELECT site_url, CAST(year AS INTEGER) AS year, files, bytes / 1e9 AS gb,
  files::DOUBLE / max(files) OVER (PARTITION BY site_url) * 100 AS width, year >= 1999 AS is_post
FROM {_breakdown('year', 'year IS NOT NULL', '(SELECT *, year(modified_ts) AS year FROM clean)')}"""
)
def s12_activity_by_year(e):
    return site.activity_by_year(e.clean, PARAMS.migrated_at)


USERS = f"""SELECT site_url, modified_by, files, files::DOUBLE / site_n * 100 AS pct_files,
  round_even(bytes / 1e9, 2) AS gb, post, last_modified, {_rank('files DESC, modified_by', 20)}
FROM {_breakdown('modified_by', 'modified_by IS NOT NULL')}"""


@query(f"{USERS} QUALIFY rank <= 20")
def s13_site_users(e):
    return site.site_users(e.clean)


@query(f"SELECT site_url, modified_by AS real_owner, files FROM ({USERS}) WHERE rank = 1")
def s14_real_owner(e):
    return site.real_owner(e.clean)


@query(
    f"""SELECT site_url, top_folder, files, bytes / 1e9 AS gb, files::DOUBLE / site_n * 100 AS pct_files,
  bytes::DOUBLE / (max(bytes) OVER (PARTITION BY site_url))::DOUBLE * 100 AS width, {_rank('bytes DESC, top_folder', 20)}
FROM {_breakdown('top_folder', 'true', f'(SELECT *, {TOP_FOLDER} AS top_folder FROM clean)')} QUALIFY rank <= 20"""
)
def s15_site_folders(e):
    return site.site_folders(e.clean)


@query(f"SELECT {SITE_LISTED} FROM clean WHERE checked_out")
def s16_site_checked_out(e):
    return site.site_checked_out(e.clean)


@query("SELECT site_url, count(*) AS checked_out FROM clean WHERE checked_out GROUP BY ALL")
def s16_checked_out_counts(e):
    return site.checked_out_counts(e.clean)


@query(
    f"""SELECT {SITE_LISTED}, {_rank(f'modified_ts DESC, {BY_SITE_LISTED}', 50)}
FROM clean WHERE is_post QUALIFY rank <= 50"""
)
def s17_site_recent_post(e):
    return site.site_recent_post(e.clean)


COUNTS = f"""SELECT site_url, count(*) FILTER (WHERE {BIG_ZIP}) AS n_zip, count(*) FILTER (WHERE ext = 'heic') AS n_heic,
  count(*) FILTER (WHERE ext = 'xlsm') AS n_xlsm, count(*) FILTER (WHERE ext = 'xlsb') AS n_xlsb,
  count(*) FILTER (WHERE ext IN ('mp4', 'mov', 'avi')) AS n_video,
  (sum(size_bytes) FILTER (WHERE ext IN ('mp4', 'mov', 'avi')))::DOUBLE / 1e9 AS video_gb, any_value(n_dups) AS n_dups, any_value(dup_gb) AS dup_gb
FROM clean LEFT JOIN (SELECT site_url, (sum(copies) - count(*))::BIGINT AS n_dups, sum(extra_bytes)::DOUBLE / 1e9 AS dup_gb
  FROM dups GROUP BY ALL) USING (site_url) GROUP BY site_url"""
DECISIONS = f"""SELECT site_url, CAST(row_number() OVER (PARTITION BY site_url ORDER BY pos) AS INTEGER) AS num,
  colour, subject, n, gb, tag FROM (
  SELECT site_url, 1 AS pos, 'red' AS colour, 'zip' AS subject, n_zip AS n, NULL::DOUBLE AS gb, 'Bloqueante SPMT' AS tag
    FROM counts WHERE n_zip > 0
  UNION ALL SELECT site_url, 2, 'gold', 'heic', n_heic, NULL, 'Experiencia de usuario' FROM counts WHERE n_heic > 0
  UNION ALL SELECT site_url, 3, 'gold', CASE WHEN n_xlsm > 0 THEN 'xlsm' ELSE 'xlsb' END,
    CASE WHEN n_xlsm > 0 THEN n_xlsm ELSE n_xlsb END, NULL, 'Post-migración' FROM counts WHERE n_xlsm + n_xlsb > 0
  UNION ALL SELECT site_url, 4, 'orange', 'video', n_video, video_gb, 'Destino alternativo' FROM counts WHERE n_video > 0
  UNION ALL SELECT site_url, 5, 'gold', 'duplicates', n_dups, dup_gb, 'Optimización' FROM counts WHERE dup_gb > 1
  UNION ALL SELECT site_url, 6, 'green', 'none', 0, NULL, 'Listo para migrar' FROM counts
    WHERE n_zip + n_heic + n_xlsm + n_xlsb + n_video = 0 AND coalesce(dup_gb, 0) <= 1)"""


@query(f"SELECT * FROM (WITH counts AS ({COUNTS}) {DECISIONS})", ("clean", "dups"))
def s18_decisions(e):
    return site.decisions(e.clean)


def s18_decisions_of_plain_sites(e):
    """Beside the other sites, subsites with one file each: some need one decision, some none."""
    return site.decisions(clean.enrich(e.table("more_files"), PARAMS))


QUERIES["s18_decisions_of_plain_sites"] = Query(
    s18_decisions_of_plain_sites,
    duckdb_sql(
        f"SELECT * FROM (WITH counts AS ({COUNTS}) {DECISIONS})",
        ("clean", "dups", "more_files"),
        overrides={"clean": _clean("more_files")},
    ),
)


def _landed_report(e: Estate) -> DataFrame:
    """The report over the clean frame, landed once in the shared folder."""
    folder = e.folder("clean")
    e.clean.write.parquet(folder)
    return report.site_report(e.spark.read.parquet(folder), PARAMS)


@query(
    f"""SELECT site_url, p.files, {STATUS} AS status,
  (SELECT count(DISTINCT category) FROM clean x WHERE x.site_url = p.site_url) AS n_categories,
  (SELECT least(count(DISTINCT ext), 15) FROM clean x WHERE x.site_url = p.site_url AND ext <> '') AS n_extensions,
  (SELECT least(count(DISTINCT modified_by), 20) FROM clean x WHERE x.site_url = p.site_url) AS n_users,
  (SELECT count(DISTINCT year(modified_ts)) FROM clean x WHERE x.site_url = p.site_url) AS n_years,
  (SELECT least(count(*), 50) FROM clean x WHERE x.site_url = p.site_url AND is_post) AS n_post,
  (SELECT least(count(*), 20) FROM clean x WHERE x.site_url = p.site_url AND size_bytes > 104857600) AS n_large,
  (SELECT count(*) FROM clean x WHERE x.site_url = p.site_url AND {BIG_ZIP}) AS n_archives,
  (SELECT max(size_bytes) FROM clean x WHERE x.site_url = p.site_url AND size_bytes > 104857600) AS largest,
  (SELECT modified_by FROM clean x WHERE x.site_url = p.site_url AND modified_by IS NOT NULL GROUP BY modified_by
    ORDER BY count(*) DESC, modified_by LIMIT 1) AS first_user,
  (SELECT sum(extra_bytes)::BIGINT FROM dups d WHERE d.site_url = p.site_url) AS extra_bytes
FROM ({PROFILE}) p""",
    ("clean", "dups"),
)
def s19_site_report(e):
    r = _landed_report(e)
    n = lambda name: F.size(name).cast("bigint")
    return r.select(
        "site_url",
        "files",
        "status",
        n("categories").alias("n_categories"),
        n("extensions").alias("n_extensions"),
        n("top_users").alias("n_users"),
        n("years").alias("n_years"),
        n("recent_post").alias("n_post"),
        n("large_files").alias("n_large"),
        F.col("oversize_archives").alias("n_archives"),
        F.try_element_at("large_files", F.lit(1))["size_bytes"].alias("largest"),
        F.try_element_at("top_users", F.lit(1))["modified_by"].alias("first_user"),
        "extra_bytes",
    )


# --- health index ------------------------------------------------------------------

POINTS = "CASE WHEN enabled AND NOT is_generic THEN 100e0 WHEN enabled THEN 50e0 ELSE 0e0 END"


@query(
    f"SELECT site_url, {POINTS} AS ownership FROM sites LEFT JOIN accounts ON owner = account",
    ("sites", "accounts"),
)
def h1_score_ownership(e):
    return health.score_ownership(e.sites, e.table("accounts"))


@query(
    f"""SELECT site_url, CASE WHEN s.owner IS NULL AND site_url IN
    (SELECT site_url FROM members JOIN accounts ON member = account WHERE enabled) THEN 50e0 ELSE {POINTS} END AS ownership
FROM sites s LEFT JOIN accounts ON owner = account""",
    ("sites", "accounts", "members"),
)
def h1_score_ownership_members(e):
    return health.score_ownership(e.sites, e.table("accounts"), members=e.table("members"))


@query(
    f"""SELECT site_url, max({POINTS}) AS ownership FROM owners LEFT JOIN accounts ON owner = account GROUP BY site_url""",
    ("owners", "accounts"),
)
def h1_score_ownership_of_several(e):
    return health.score_ownership(e.sites, e.table("accounts"), e.table("owners"))


@query(
    f"""SELECT site_url, CASE WHEN is_hub OR hub_id <> '{c.NO_ID}' OR regexp_matches(site, '^Supplier#0+1\\d?$')
  THEN 100e0 ELSE 0e0 END AS architecture FROM sites""",
    ("sites",),
)
def h2_score_architecture(e):
    return health.score_architecture(e.sites, LISTS.name_patterns)


@query(
    "SELECT site_url, CASE WHEN sharing IN ('Disabled', 'ExistingExternalUserSharingOnly') THEN 100e0 ELSE 0e0 END AS sharing FROM sites",
    ("sites",),
)
def h3_score_sharing(e):
    return health.score_sharing(e.sites)


@query(
    """SELECT site_url, coalesce(sum(size_bytes) FILTER (WHERE copy_no > 1), 0)::BIGINT AS dup_bytes
FROM flagged WHERE size_bytes > 0 GROUP BY ALL""",
    ("flagged",),
)
def h4_dup_volume(e):
    return health.dup_volume(e.clean)


@query(
    """SELECT site_url, sum(size_bytes * (similar_copies - 1))::BIGINT AS dup_bytes FROM (
  SELECT f.site_url, f.file_name, f.size_bytes, count(*) FILTER (WHERE
      len(list_intersect(string_split(upper(f.folder), '/'), string_split(upper(k.folder), '/')))::DOUBLE
      / len(list_distinct(list_concat(string_split(upper(f.folder), '/'), string_split(upper(k.folder), '/')))) >= 0.5) AS similar_copies
  FROM flagged f JOIN flagged k ON f.site_url = k.site_url AND f.file_name = k.file_name AND f.size_bytes = k.size_bytes
    AND f.ext = k.ext AND k.copy_no = 1
  WHERE f.size_bytes > 0 GROUP BY ALL HAVING count(*) > 1) GROUP BY site_url""",
    ("flagged",),
)
def h4_dup_volume_similar(e):
    return health.dup_volume(e.clean, similar=0.5)


@query(
    f"""SELECT site_url, coalesce(sum(size_bytes) FILTER (WHERE legacy), 0)::BIGINT AS legacy_bytes
FROM flagged WHERE ext IN ('doc', 'docx', 'xls', 'xlsx') OR {BIG_ZIP} GROUP BY ALL""",
    ("flagged",),
)
def h5_legacy_volume(e):
    return health.legacy_volume(e.clean)


@query(
    f"""SELECT site_url, coalesce(sum(size_bytes) FILTER (WHERE legacy OR ext IN ('dwg', 'xer')), 0)::BIGINT AS legacy_bytes
FROM flagged WHERE ext IN ('doc', 'docx', 'xls', 'xlsx', 'dwg', 'xer') OR {BIG_ZIP} GROUP BY ALL""",
    ("flagged",),
)
def h5_legacy_volume_with_binaries(e):
    return health.legacy_volume(e.clean, ["dwg", "XER"])


@query(
    f"SELECT site_url, sum(size_bytes)::BIGINT AS junk_bytes FROM clean WHERE {JUNK} GROUP BY ALL"
)
def h6_junk_volume(e):
    return health.junk_volume(e.clean)


@query("SELECT site_url, bytes, quality FROM dims", ("dims",))
def h7_score_quality(e):
    return health.score_quality(e.clean, PARAMS).select("site_url", "bytes", "quality")


@query(
    """SELECT site_url, sum(size_bytes)::BIGINT AS bytes, noise::BIGINT AS noise_bytes,
  greatest(100 - noise::DOUBLE / sum(size_bytes)::DOUBLE * 100, 0) AS quality
FROM (SELECT site_url, size_bytes, sum(CASE WHEN copy_no > 1 OR legacy OR junk THEN size_bytes ELSE 0 END)
  OVER (PARTITION BY site_url) AS noise FROM flagged) GROUP BY site_url, noise""",
    ("flagged",),
)
def h7_score_quality_union(e):
    return health.score_quality(e.clean, PARAMS, overlap="union")


@query(
    "SELECT site_url, CASE WHEN has_retention THEN 100e0 ELSE 0e0 END AS lifecycle FROM sites",
    ("sites",),
)
def h8_score_lifecycle(e):
    return health.score_lifecycle(e.sites)


@query(
    """SELECT site_url, sum(size_bytes)::BIGINT AS bytes, sum(active)::BIGINT AS active_bytes,
  sum(active)::DOUBLE / sum(size_bytes)::DOUBLE * 100 AS activity
FROM (SELECT *, CASE WHEN modified_ts BETWEEN TIMESTAMP '2001-08-07' AND TIMESTAMP '2001-11-05' THEN size_bytes ELSE 0 END AS active
  FROM clean) GROUP BY site_url"""
)
def h9_score_activity(e):
    return health.score_activity(e.clean, PARAMS.as_of, PARAMS.activity_days)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Sums of doubles depend on the order of rows in their last digits."""
    return df.withColumns({name: F.round(name, 6) for name in names})


@query("SELECT * FROM indexed", ("indexed",))
def h10_site_index(e):
    return e.indexed


@query(
    "SELECT round(sum(health * bytes) / sum(bytes) FILTER (WHERE health IS NOT NULL), 6) AS health FROM indexed",
    ("indexed",),
)
def h11_tenant_index(e):
    return _rounded(health.tenant_index(e.indexed), "health")


RECONCILED = """
SELECT count(*) FILTER (WHERE kind = 'listed') AS listed_sites, count(*) FILTER (WHERE kind = 'unlisted') AS unlisted_sites,
  count(*) FILTER (WHERE kind = 'empty') AS empty_sites,
  """ + ", ".join(
    f"coalesce(sum(files) FILTER (WHERE kind = '{k}'), 0)::BIGINT AS {k}_files,"
    f" coalesce(sum(bytes) FILTER (WHERE kind = '{k}'), 0)::DOUBLE / 1e9 AS {k}_gb" for k in ("listed", "unlisted", "unplaced")
) + """
FROM (SELECT *, CASE WHEN files IS NULL THEN 'empty' WHEN l.site_url IS NOT NULL THEN 'listed'
    WHEN f.site_url IS NOT NULL THEN 'unlisted' ELSE 'unplaced' END AS kind
  FROM (SELECT CASE WHEN survey_no = 2 AND checked_out THEN NULL ELSE site_url END AS site_url,
      count(*) AS files, sum(size_bytes) AS bytes FROM clean GROUP BY 1) f
  FULL JOIN (SELECT DISTINCT site_url FROM listed_sites) l ON f.site_url = l.site_url)"""


def _unplaced(files: DataFrame) -> DataFrame:
    """Some files whose rows name no site."""
    lost = (F.col("survey_no") == 2) & F.col("checked_out")
    return files.withColumn("site_url", F.when(~lost, F.col("site_url")))


QUERIES["h11_reconciliation"] = Query(
    lambda e: health.reconciliation(_unplaced(clean.enrich(e.table("more_files"), PARAMS)), e.table("listed_sites")),
    duckdb_sql(RECONCILED, ("clean", "more_files", "listed_sites"), {"clean": _clean("more_files")}),
)


def h11_tenant_index_reconciled(e):
    files, listed = clean.enrich(e.table("more_files"), PARAMS), e.table("listed_sites")
    indexed = health.health_index(files, listed, e.table("accounts"), PARAMS)
    return _rounded(health.tenant_index_reconciled(indexed, files, listed), "health", "pct_weighed")


QUERIES["h11_tenant_index_reconciled"] = Query(
    h11_tenant_index_reconciled,
    duckdb_sql(
        f"""SELECT r.*, round(listed_gb / (listed_gb + unlisted_gb + unplaced_gb) * 100, 6) AS pct_weighed,
  (SELECT round(sum(({_index()}) * bytes) / sum(bytes) FILTER (WHERE ({_index()}) IS NOT NULL), 6) FROM dims) AS health
FROM ({RECONCILED.replace("CASE WHEN survey_no = 2 AND checked_out THEN NULL ELSE site_url END", "site_url")}) r""",
        ("clean", "more_files", "listed_sites", "dims"),
        {"clean": _clean("more_files"), "dims": _dims("site_url").replace("FROM sites ", "FROM listed_sites ")},
    ),
)


@query(f"SELECT site_url, health, {STAGE} AS maturity FROM indexed", ("indexed",))
def h12_maturity(e):
    return health.maturity(e.indexed).select("site_url", "health", "maturity")


@query(
    " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, round(sum({d} * bytes) / sum(bytes), 6) AS score FROM dims"
        for d in health.DIMENSIONS
    ),
    ("dims",),
)
def h13_tenant_dimensions(e):
    return _rounded(health.tenant_dimensions(e.dims), "score")


@query(
    f"""SELECT survey_no, round(health, 6) AS health, round(health - lag(health) OVER (ORDER BY survey_no), 6) AS change
FROM (SELECT survey_no, sum(({_index()}) * bytes) / sum(bytes) AS health FROM ({_dims('survey_no, site_url')}) GROUP BY 1)""",
    ("clean", "sites", "accounts"),
)
def h14_index_trend(e):
    dims = health.dimensions(e.clean, e.sites, e.table("accounts"), PARAMS, version="survey_no")
    return _rounded(health.index_trend(health.site_index(dims)), "health", "change")


@query(
    f"""SELECT survey_no, round(health, 6) AS health, sites, carried, round(health - lag(health) OVER (ORDER BY survey_no), 6) AS change
FROM (SELECT survey_no, sum(health * bytes) / sum(bytes) FILTER (WHERE health IS NOT NULL) AS health, count(*) AS sites,
    count(*) FILTER (WHERE scored_in < survey_no) AS carried
  FROM (SELECT v.survey_no, d.scored_in, d.bytes, d.health FROM (SELECT DISTINCT survey_no FROM refreshed_files) v
    JOIN (SELECT survey_no AS scored_in, site_url, bytes, {_index()} AS health FROM ({_dims('survey_no, site_url')})) d
      ON d.scored_in <= v.survey_no
    QUALIFY row_number() OVER (PARTITION BY v.survey_no, site_url ORDER BY scored_in DESC) = 1)
  GROUP BY survey_no)""",
    ("clean", "refreshed_files", "sites", "accounts"),
    {"clean": _clean("refreshed_files")},
)
def h14_estate_trend_of_a_refresh(e):
    files = clean.enrich(e.table("refreshed_files"), PARAMS)
    dims = health.dimensions(files, e.sites, e.table("accounts"), PARAMS, version="survey_no")
    return _rounded(health.estate_trend(health.site_index(dims)), "health", "change")


@query(
    f"""SELECT v.survey_no, d.site_url, d.scored_in, d.bytes, d.health FROM (SELECT DISTINCT survey_no FROM refreshed_files) v
JOIN (SELECT survey_no AS scored_in, site_url, bytes, {_index()} AS health FROM ({_dims('survey_no, site_url')})) d
  ON d.scored_in <= v.survey_no
QUALIFY row_number() OVER (PARTITION BY v.survey_no, d.site_url ORDER BY scored_in DESC) = 1""",
    ("clean", "refreshed_files", "sites", "accounts"),
    {"clean": _clean("refreshed_files")},
)
def h14_carried(e):
    files = clean.enrich(e.table("refreshed_files"), PARAMS)
    dims = health.dimensions(files, e.sites, e.table("accounts"), PARAMS, version="survey_no")
    return health.carried(health.site_index(dims)).select("survey_no", "site_url", "scored_in", "bytes", "health")


@query(
    " UNION ALL ".join(
        f"SELECT site_url, bytes, '{name}' AS profile, {_index(w)} AS health FROM dims"
        for name, w in PROFILES.items()
    ),
    ("dims",),
)
def h15_reweight(e):
    return health.reweight(e.dims, PROFILES)


@query(
    """SELECT site_url, sum(size_bytes)::BIGINT AS bytes, sum(old)::BIGINT AS stale_bytes,
  sum(old)::DOUBLE / sum(size_bytes)::DOUBLE * 100 AS pct_stale
FROM (SELECT *, CASE WHEN modified_ts < TIMESTAMP '1996-11-05' THEN size_bytes ELSE 0 END AS old FROM clean)
GROUP BY site_url HAVING sum(old) * 2 > sum(size_bytes)"""
)
def h16_stale_sites(e):
    return health.stale_sites(e.clean, PARAMS.as_of, years=5)


# --- debt patterns -----------------------------------------------------------------


@query(
    """SELECT site_url, modified_by, count(*) AS files, sum(size_bytes)::BIGINT AS bytes, sum(size_bytes)::DOUBLE / 1e9 AS gb,
  CASE WHEN any_value(account) IS NULL THEN 'unknown' ELSE 'disabled' END AS account_state
FROM clean LEFT JOIN accounts ON modified_by = account
WHERE modified_by IS NOT NULL AND NOT coalesce(enabled, false) GROUP BY site_url, modified_by""",
    ("clean", "accounts"),
)
def d1_departed_user_content(e):
    return debt.departed_user_content(e.clean, e.table("accounts"))


@query(
    f"""SELECT site_url, folder, count(*) AS files, sum(size_bytes)::BIGINT AS bytes, max(modified_ts) AS last_modified,
  sum(size_bytes)::DOUBLE / 1e9 AS gb,
  CAST(date_diff('day', max(modified_ts)::DATE, DATE '2001-11-05') AS INTEGER) AS days_idle
FROM clean WHERE {JUNK} GROUP BY ALL"""
)
def d2_unarchived_junk(e):
    return debt.unarchived_junk(e.clean, PARAMS.as_of)


@query(
    f"""SELECT *, zips::DOUBLE / files * 100 AS pct_zips,
  CASE WHEN bytes > 0 THEN zip_bytes::DOUBLE / bytes::DOUBLE * 100 ELSE 0 END AS pct_zip_bytes
FROM (SELECT site_url, {TOP_FOLDER} AS top_folder, count(*) AS files, count(*) FILTER (WHERE ext = 'zip') AS zips,
    sum(size_bytes)::BIGINT AS bytes, sum(CASE WHEN ext = 'zip' THEN size_bytes ELSE 0 END)::BIGINT AS zip_bytes
  FROM clean GROUP BY ALL)"""
)
def d3_zip_emission(e):
    return debt.zip_emission(e.clean)


@query(
    """SELECT site, site_url, template, sharing FROM sites
WHERE template LIKE 'TEAMCHANNEL%' AND sharing NOT IN ('Disabled', 'ExistingExternalUserSharingOnly')""",
    ("sites",),
)
def d4_external_sharing_in_channels(e):
    found = debt.external_sharing_in_channels(e.sites)
    return found.select(*SITE_ROW, "template", "sharing")


# --- answers from stored cells, by the same SQL as from the files ---------------------


STORED = {
    "t1_corpus_totals": lambda e: store.corpus_totals(e.stored),
    "t2_site_summary": lambda e: store.site_summary(e.stored),
    "s1_site_profile": lambda e: store.site_profile(e.stored),
    "s3_site_categories": lambda e: store.site_categories(e.stored),
    "s5_site_extensions": lambda e: store.site_extensions(e.stored),
    "s12_activity_by_year": lambda e: store.activity_by_year(e.stored, PARAMS),
    "s13_site_users": lambda e: store.site_users(e.stored),
    "s15_site_folders": lambda e: store.site_folders(e.stored),
}
for _name, _run in STORED.items():
    QUERIES[f"{_name}_stored"] = Query(_run, QUERIES[_name].sql)


# --- streaming ---------------------------------------------------------------------


FILES_PER_TRIGGER = 8


def _landed_batches(e: Estate) -> str:
    """Files as three landed survey batches, newest first so that older rows arrive late.

    A survey lands in as many files as a trigger takes at most: so it arrives as one batch, however large it is.
    """
    folder = e.folder("landed")
    for number in (2, 0, 1):
        batch = e.files.where(F.col("survey_no") == number).coalesce(FILES_PER_TRIGGER)
        batch.write.mode("append").option("compression", "zstd").parquet(folder)
    return folder


def _stream(e: Estate) -> DataFrame:
    return streams.stream_files(e.spark, _landed_batches(e), max_files_per_trigger=FILES_PER_TRIGGER)


def _finish(stream_query) -> None:
    stream_query.awaitTermination()


@query("SELECT * FROM files", ("files",))
def st1_stream_files(e):
    out = e.folder("st1")
    _finish(streams.land(_stream(e), f"{out}/rows", f"{out}/checkpoint"))
    return e.spark.read.parquet(f"{out}/rows")


@query("SELECT * FROM latest", ("latest",))
def st2_stream_latest(e):
    out = e.folder("st2")
    _finish(streams.stream_snapshot(_stream(e), out, f"{out}/checkpoint", buckets=16))
    return streams.read_snapshot(e.spark, out)


@query(
    """SELECT * FROM latest WHERE (site_url, survey_no) IN
  (SELECT (site_url, max(survey_no)) FROM files GROUP BY site_url)""",
    ("latest", "files"),
)
def st2_stream_latest_without_missing(e):
    out = e.folder("st2")
    _finish(streams.stream_snapshot(_stream(e), out, f"{out}/checkpoint", drop_missing=True, buckets=16))
    return streams.read_snapshot(e.spark, out)


METRICS = ["files", "gb", "post", "users", "recommendation"]


def _metrics_sql() -> str:
    """Summary and index over the latest snapshot instead of all rows."""
    select = f"SELECT site_url, {', '.join(METRICS)}, health, {STAGE} AS maturity FROM summary JOIN indexed USING (site_url)"
    return duckdb_sql(
        select, ("latest", "summary", "indexed"), overrides={"clean": _clean("latest")}
    )


def st3_stream_site_metrics(e):
    out = e.folder("st3")
    _finish(streams.stream_site_metrics(_stream(e), PARAMS, out, f"{out}/checkpoint", buckets=16))
    metrics = streams.read_metrics(e.spark, out, e.sites, e.table("accounts"), PARAMS)
    return metrics.select("site_url", *METRICS, "health", "maturity")


QUERIES["st3_stream_site_metrics"] = Query(st3_stream_site_metrics, _metrics_sql())
