"""Estate tables as views over the generated TPC-H-like tables.

The SQL is the same text in Spark and DuckDB, except for the name of the
timestamp type. `VIEWS` is ordered: a view only uses tables and earlier views.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from corpus_health.params import Params
from corpus_health.sources.shared import landed

PARAMS = Params(migrated_at=datetime(1999, 7, 1), as_of=datetime(2001, 11, 5))

BASE_TABLES = ["customer", "lineitem", "orders", "supplier"]

#: Lines need not be sorted to meet their orders: the orders of a task are looked up by hash, whatever the size.
SPARK_HINTS = {"SELECT s_name AS site,\n": "SELECT /*+ SHUFFLE_HASH(orders) */ s_name AS site,\n"}

VIEWS: dict[str, str] = {}

# The views of FIXTURES.md; artifacts has its two versions as a union.
VIEWS["files"] = """
SELECT t.*, concat(replace(site_url, 'https://tenant.example', ''), '/', folder, '/', file_name) AS path FROM (
SELECT s_name AS site,
  concat('https://tenant.example/sites/s', cast(l_suppkey AS string)) AS site_url,
  CASE l_linenumber WHEN 1 THEN 'Documents' WHEN 2 THEN 'Site Assets' WHEN 7 THEN CAST(NULL AS string)
       ELSE concat('Library ', cast(l_linenumber AS string)) END AS library,
  concat('Documents/', CASE l_orderkey % 7 WHEN 0 THEN 'SUPERADO' WHEN 1 THEN 'Finance' WHEN 2 THEN 'Legal'
       WHEN 3 THEN 'HR/Policies' WHEN 4 THEN 'Projects/TMP' WHEN 5 THEN 'Projects/2001'
       ELSE 'Projects/2001/Plans' END) AS folder,
  concat('file_', cast(l_partkey % 7 AS string), CASE l_partkey % 20
       WHEN 0 THEN '.pdf' WHEN 1 THEN '.docx' WHEN 2 THEN '.doc' WHEN 3 THEN '.xlsx' WHEN 4 THEN '.xls'
       WHEN 5 THEN '.xlsm' WHEN 6 THEN '.xlsb' WHEN 7 THEN '.pptx' WHEN 8 THEN '.jpg' WHEN 9 THEN '.heic'
       WHEN 10 THEN '.mp4' WHEN 11 THEN '.zip' WHEN 12 THEN '.rar' WHEN 13 THEN '.dwg' WHEN 14 THEN '.msg'
       WHEN 15 THEN '.mpp' WHEN 16 THEN '.txt' WHEN 17 THEN '.xer' WHEN 18 THEN '' ELSE '.PDF' END) AS file_name,
  cast(l_quantity AS bigint) * (CASE l_suppkey % 4 WHEN 0 THEN 7340032 WHEN 1 THEN 262144
       WHEN 2 THEN 16384 ELSE 7340032 END) * (CASE WHEN l_orderkey % 211 = 0 THEN 0 ELSE 1 END) AS size_bytes,
  o_orderdate AS created_ts,
  CASE WHEN l_orderkey % 97 = 0 THEN NULL
       ELSE l_shipdate - INTERVAL '1' DAY * cast((l_suppkey % 5) * 400 AS int) END AS modified_ts,
  concat('user_', cast(o_custkey % 50 AS string)) AS created_by,
  CASE WHEN l_orderkey % 89 = 0 THEN CAST(NULL AS string)
       ELSE concat('user_', cast(l_orderkey % 60 AS string)) END AS modified_by,
  CASE WHEN l_returnflag = 'R' AND l_linenumber = 3 THEN true ELSE false END AS checked_out,
  cast(l_orderkey % 3 AS int) AS survey_no
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey) t
"""
VIEWS["files_raw"] = """
SELECT site, site_url, library, folder, file_name, path,
  CASE WHEN size_bytes % 13 = 1 THEN 'n/a' WHEN size_bytes = 0 THEN CAST(NULL AS string)
       ELSE cast(size_bytes AS string) END AS size_bytes,
  CASE WHEN modified_by = 'user_7' THEN '31/12/1999' ELSE substring(cast(modified_ts AS string), 1, 16) END AS modified_ts,
  substring(cast(created_ts AS string), 1, 10) AS created_ts,
  created_by, modified_by, CASE WHEN checked_out THEN 'Sí' ELSE 'No' END AS checked_out
FROM files
"""
VIEWS["sites"] = """
SELECT s_name AS site, concat('https://tenant.example/sites/s', cast(s_suppkey AS string)) AS site_url,
  CASE s_suppkey % 7 WHEN 0 THEN 'GROUP#0' WHEN 1 THEN 'TEAMCHANNEL#0' WHEN 2 THEN 'SITEPAGEPUBLISHING#0'
       WHEN 3 THEN 'STS#3' WHEN 4 THEN 'GROUP#2' WHEN 5 THEN 'TEAMCHANNEL#1' ELSE 'EHS#1' END AS template,
  s_suppkey % 13 = 0 AS is_hub,
  CASE WHEN s_nationkey % 3 = 0 THEN '00000000-0000-0000-0000-000000000000'
       ELSE concat('hub-', cast(s_nationkey AS string)) END AS hub_id,
  s_acctbal AS storage_mb,
  CASE s_suppkey % 5 WHEN 0 THEN CAST(NULL AS string) WHEN 1 THEN 'svc_it'
       ELSE concat('user_', cast(s_suppkey % 60 AS string)) END AS owner,
  CASE s_suppkey % 4 WHEN 0 THEN 'Disabled' WHEN 1 THEN 'ExistingExternalUserSharingOnly'
       WHEN 2 THEN 'ExternalUserSharingOnly' ELSE 'ExternalUserAndGuestSharing' END AS sharing,
  CASE WHEN s_suppkey % 11 = 0 THEN 'ReadOnly' ELSE 'Unlock' END AS lock_state,
  s_suppkey % 6 = 0 AS has_retention,
  TIMESTAMP_NTZ '2001-11-05 00:00:00' - INTERVAL '1' DAY * cast((s_suppkey % 5) * 400 AS int) AS last_activity_ts
FROM supplier
"""
VIEWS["accounts"] = """
SELECT concat('user_', cast(c_custkey AS string)) AS account, c_custkey % 4 <> 3 AS enabled, false AS is_generic
FROM customer WHERE c_custkey < 60
UNION ALL SELECT 'svc_it' AS account, true AS enabled, true AS is_generic
"""
VIEWS["surveys"] = """
SELECT concat('https://tenant.example/sites/s', cast(s_suppkey AS string)) AS site_url,
  TIMESTAMP_NTZ '2001-11-05 12:00:00' - INTERVAL '1' DAY * cast((s_suppkey % 4) * 150 AS int) AS surveyed_ts,
  CASE s_suppkey % 8 WHEN 5 THEN 'ErrorConexion' WHEN 6 THEN 'SinArchivos' ELSE 'OK' END AS status
FROM supplier WHERE s_suppkey % 3 <> 0
"""
VIEWS["reports"] = """
SELECT s_suppkey AS ordinal, concat('https://tenant.example/sites/s', cast(s_suppkey AS string)) AS site_url,
  concat('priority_', cast(s_suppkey AS string)) AS artifact, concat('hub-', cast(s_nationkey AS string)) AS destination
FROM supplier WHERE s_suppkey % 5 = 0
"""
VIEWS["artifacts"] = """
SELECT concat('https://tenant.example/sites/s', cast(s_suppkey AS string)) AS site_url,
  CASE WHEN s_suppkey % 5 = 0 THEN concat('priority_', cast(s_suppkey AS string))
       ELSE concat('auto_', cast(s_suppkey AS string), '_', cast(v AS string)) END AS artifact,
  TIMESTAMP_NTZ '2001-11-01 00:00:00' + INTERVAL '1' DAY * cast(v AS int) AS written_ts
FROM (SELECT s_suppkey, 1 AS v FROM supplier UNION ALL SELECT s_suppkey, 2 AS v FROM supplier) x
WHERE s_suppkey % 2 = 1
"""

# Views the operators need beyond those of FIXTURES.md.
VIEWS["listing"] = """
SELECT site, site_url, library, path AS file_ref, file_name AS file_leaf,
  CASE WHEN size_bytes = 0 THEN 'Folder' ELSE 'File' END AS object_type,
  CASE WHEN file_name NOT LIKE '%.%' THEN CAST(NULL AS string) ELSE split_part(file_name, '.', 2) END AS file_type,
  cast(size_bytes AS string) AS file_size, created_ts, modified_ts,
  named_struct('lookup_value', created_by) AS author,
  named_struct('lookup_value', modified_by) AS editor,
  concat(cast(survey_no + 1 AS string), '.0') AS version,
  CASE WHEN checked_out THEN modified_by ELSE CAST(NULL AS string) END AS checkout_user
FROM files
"""
VIEWS["subsites"] = """
SELECT concat('Sub of ', site) AS site, concat(site_url, '/sub') AS site_url, site_url AS parent_url,
  template, last_activity_ts
FROM sites WHERE is_hub OR has_retention
"""
VIEWS["inventory_runs"] = """
SELECT sites.*, TIMESTAMP_NTZ '2001-11-01 00:00:00' AS run_ts FROM sites
UNION ALL SELECT sites.*, TIMESTAMP_NTZ '2001-11-04 00:00:00' AS run_ts FROM sites WHERE NOT is_hub
"""
VIEWS["owners"] = """
SELECT site_url, owner FROM sites
UNION ALL SELECT site_url, 'svc_it' AS owner FROM sites WHERE has_retention
UNION ALL SELECT site_url, 'user_3' AS owner FROM sites WHERE is_hub
UNION ALL SELECT site_url, 'user_4' AS owner FROM sites WHERE lock_state = 'ReadOnly'
"""
VIEWS["members"] = """
SELECT site_url, concat('user_', cast(length(site) % 60 AS string)) AS member FROM sites WHERE owner IS NULL AND has_retention
UNION ALL SELECT site_url, 'user_3' AS member FROM sites WHERE owner IS NULL AND is_hub
UNION ALL SELECT site_url, 'user_4' AS member FROM sites WHERE lock_state = 'ReadOnly'
"""
VIEWS["grouped_sites"] = """
SELECT sites.*, CASE WHEN template LIKE 'GROUP%' THEN concat('group-', site) WHEN is_hub THEN CAST(NULL AS string)
       ELSE '00000000-0000-0000-0000-000000000000' END AS group_id,
  last_activity_ts - INTERVAL '1' DAY * 30 AS created_ts
FROM sites
"""
# Sites without any file, and sites with a few plain files only.
VIEWS["visited_sites"] = """
SELECT site, site_url FROM sites UNION ALL SELECT site, site_url FROM subsites
"""
VIEWS["more_files"] = """
SELECT * FROM files
UNION ALL SELECT site, site_url, 'Documents' AS library, 'Documents/Plain' AS folder,
  CASE WHEN template LIKE 'STS%' THEN 'book.xlsb' WHEN template LIKE 'GROUP%' THEN 'clip.mp4' ELSE 'plan.docx' END AS file_name,
  cast(1000 AS bigint) AS size_bytes, last_activity_ts AS created_ts, last_activity_ts AS modified_ts,
  'user_1' AS created_by, 'user_1' AS modified_by, false AS checked_out, cast(1 AS int) AS survey_no,
  concat(replace(site_url, 'https://tenant.example', ''), '/Documents/Plain/', site) AS path
FROM subsites
"""
# A refresh: the second of three surveys lists some sites only.
VIEWS["refreshed_files"] = """
SELECT * FROM files WHERE survey_no <> 1 OR site LIKE '%1' OR site LIKE '%4' OR site LIKE '%7'
"""
# An inventory that lists sites without files, and misses the subsites that `more_files` has files of.
VIEWS["listed_sites"] = """
SELECT * FROM sites
UNION ALL SELECT concat('Empty ', site) AS site, concat(site_url, '/empty') AS site_url, template, is_hub, hub_id, storage_mb,
  owner, sharing, lock_state, has_retention, last_activity_ts
FROM sites WHERE is_hub
"""
# Runs of each survey; the newest one of some sites did not come to its end.
VIEWS["runs"] = """
SELECT concat('https://tenant.example/sites/s', cast(s_suppkey AS string)) AS site_url, cast(v AS int) AS survey_no,
  CASE WHEN v = 2 AND s_suppkey % 3 = 0 THEN 'ErrorConexion' WHEN s_suppkey % 10 = 9 THEN 'SinArchivos' ELSE 'OK' END AS status
FROM (SELECT s_suppkey, 0 AS v FROM supplier UNION ALL SELECT s_suppkey, 1 AS v FROM supplier
  UNION ALL SELECT s_suppkey, 2 AS v FROM supplier) x
"""


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture view; it reads only the tables and earlier views it names, and the files as they are landed."""
    if name == "files":
        return _landed_files(spark, sf_dir)
    return _view(spark, sf_dir, name)


def _view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    views = [view for view in needed(name) if view == name or view != "files"]
    used = " ".join(VIEWS[view] for view in views)
    tables = {
        t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in BASE_TABLES if f" {t}" in used
    }
    if name != "files" and "files" in needed(name):
        tables["files"] = _landed_files(spark, sf_dir)
    ctes = [f"{t} AS (SELECT * FROM {{{t}}})" for t in tables]
    ctes += [f"{view} AS ({VIEWS[view]})" for view in views if view != name]
    body = VIEWS[name]
    for plain, hinted in SPARK_HINTS.items():
        body = body.replace(plain, hinted)
    return spark.sql(f"WITH {', '.join(ctes)} {body}", **tables)


_landed: dict[tuple[str, str], DataFrame] = {}


def _landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files view, joined once and read by every query in as many tasks as it has parts for.

    Spark sizes the parts: a given table can be a single row group, which one task would read.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        _landed[key] = landed(_view(spark, sf_dir, "files"), "lineitem-files", compression="zstd")
    return _landed[key]


def needed(name: str) -> list[str]:
    """The view and the views below it, in order."""
    found = {name}
    for view in reversed(list(VIEWS)):
        if view in found:
            found |= {v for v in VIEWS if v != view and re.search(rf"\b(FROM|JOIN) {v}\b", VIEWS[view])}
    return [view for view in VIEWS if view in found]


def duckdb_ctes(names: list[str]) -> str:
    """The same views as DuckDB common table expressions."""
    wanted = {v for name in names for v in needed(name)}
    ctes = []
    for view, sql in VIEWS.items():
        if view in wanted:
            sql = sql.replace("TIMESTAMP_NTZ", "TIMESTAMP")
            sql = re.sub(r"named_struct\('(\w+)', (\w+)\)", r"{'\1': \2}", sql)
            ctes.append(f"{view} AS ({sql})")
    return ",\n".join(ctes)
