"""One site, one name, one path with most of the rows: same results, spread plans."""

from collections import Counter, defaultdict

import pytest
from conftest import collect
from pyspark.sql import functions as F

from corpus_health.operators import refresh, site, tenant
from corpus_health.plans import cells, skew

N = 20_000


@pytest.fixture(scope="module")
def hot(spark):
    """Site `hot` holds 70 % of the rows, half of them copies of one file."""
    i = F.col("id")
    rows = spark.range(N).select(
        F.when(i % 10 < 7, "hot").otherwise(F.concat(F.lit("s"), i % 50)).alias("site_url"),
        F.when(i % 2 == 0, "same").otherwise(F.concat(F.lit("f"), i % 997)).alias("file_name"),
        F.when(i % 2 == 0, 7).otherwise(i % 13).alias("size_bytes"),
        F.concat(F.lit("u"), i % 331).alias("modified_by"),
        F.when(i % 2 == 0, "same").otherwise(F.concat(F.lit("p"), i % 4001)).alias("path"),
        (i % 5).cast("int").alias("survey_no"),
        (i % 3 == 0).alias("is_post"),
        F.lit(False).alias("is_inactive"),
        F.lit(None).cast("timestamp_ntz").alias("modified_ts"),
    )
    return rows.cache()


@pytest.fixture(scope="module")
def local(hot):
    return [r.asDict() for r in hot.collect()]


@pytest.mark.parametrize("hot_groups", [False, True])
def test_top_k(hot, local, hot_groups):
    order = [F.desc("size_bytes"), F.asc("path"), F.asc("survey_no"), F.asc("modified_by")]
    df = hot.select("site_url", "size_bytes", "path", "survey_no", "modified_by")
    got = collect(skew.top_k(df, ["site_url"], order, 5, hot=hot_groups))
    groups = defaultdict(list)
    for r in local:
        groups[r["site_url"]].append(r)
    expected = []
    for url, rows in groups.items():
        rows.sort(key=lambda r: (-r["size_bytes"], r["path"], r["survey_no"], r["modified_by"]))
        expected += [
            (url, r["size_bytes"], r["path"], r["survey_no"], r["modified_by"], n)
            for n, r in enumerate(rows[:5], 1)
        ]
    assert got == sorted(expected, key=str)


def test_breakdown(hot, local):
    got = collect(
        cells.by_site(hot, "modified_by", ["files"], 4), "site_url", "modified_by", "n", "rank", "site_n", "max_files"
    )
    counts = defaultdict(Counter)
    for r in local:
        counts[r["site_url"]][r["modified_by"]] += 1
    expected = []
    for url, users in counts.items():
        top = sorted(users.items(), key=lambda x: (-x[1], x[0]))[:4]
        expected += [(url, u, n, k, sum(users.values()), top[0][1]) for k, (u, n) in enumerate(top, 1)]
    assert got == sorted(expected, key=str)


def test_distinct_counts(hot, local):
    df = hot.withColumns({"site": F.col("site_url"), "library": F.col("path"), "category": F.lit("c")})
    got = dict(collect(tenant.site_summary(df), "site_url", "users"))
    users = defaultdict(set)
    for r in local:
        users[r["site_url"]].add(r["modified_by"])
    assert got == {url: len(u) for url, u in users.items()}


def test_duplicates_and_snapshot(hot, local):
    groups = Counter((r["site_url"], r["file_name"], r["size_bytes"]) for r in local if r["size_bytes"] > 0)
    extra = sum(n - 1 for n in groups.values())
    assert site.duplicate_totals(site.duplicates(hot)).agg(F.sum("extra_files")).collect()[0][0] == extra
    paths = {(r["site_url"], r["path"]) for r in local}
    assert refresh.latest_snapshot(hot).count() == len(paths)
    newest = max(r["survey_no"] for r in local if r["site_url"] == "hot")
    kept = refresh.latest_snapshot(hot, drop_missing=True).where("site_url = 'hot'")
    assert {r.survey_no for r in kept.collect()} == {newest}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join(hot, frame, how):
    small = frame("site_url string, note string", ("hot", "x"), ("s1", "y"), ("none", "z"))
    plain = hot.join(small, "site_url", how)
    salted = skew.salted_join(hot, small, ["site_url"], how)
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).count() == plain.exceptAll(salted).count() == 0


def test_hot_key_spreads_over_tasks(spark, hot, frame):
    """Without broadcast, no join task receives the whole hot site."""
    small = frame("site_url string, note string", ("hot", "x"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_join(hot, small, ["site_url"], "inner")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == N * 7 // 10 and len(sizes) > 1 and max(sizes) < 0.7 * sum(sizes)


def test_one_name_in_very_many_folders(spark, monkeypatch):
    """60,000 folders under one name are compared in several tasks, from one scan, without broadcast by size."""
    from corpus_health.operators import health

    n = 60_000
    i = F.col("id")
    rows = spark.range(n + 3000).select(
        F.lit("hot").alias("site_url"),
        F.when(i < n, "same").otherwise(F.concat(F.lit("f"), i % 1000)).alias("file_name"),
        F.lit(7).cast("bigint").alias("size_bytes"),
        F.lit("pdf").alias("ext"),
        F.concat(F.lit("Docs/"), i % 2, F.lit("/"), i).alias("folder"),
        F.format_string("p%06d", i).alias("path"),
    )
    old = {name: spark.conf.get(name) for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    for name, value in zip(old, ("-1", "false"), strict=True):
        spark.conf.set(name, value)
    seen = {}

    def watched(*args):
        seen["rows"] = skew.heavy_join(*args)
        return seen["rows"]

    monkeypatch.setattr(health, "heavy_join", watched)
    try:
        got = health.dup_volume(rows, similar=0.5).collect()
        sizes = [r["count"] for r in seen["rows"].groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    # names like Docs and 0 are shared by half of the 60,000, and by none of the few copies of other names in both halves
    folder = lambda k: {"Docs", str(k % 2), str(k)}
    alike = lambda a, b: len(folder(a) & folder(b)) * 2 >= len(folder(a) | folder(b))
    want = sum(alike(0, k) for k in range(1, n)) + sum(alike(n + k % 1000, n + k) for k in range(1000, 3000))
    assert [r.dup_bytes for r in got] == [7 * want]
    assert sum(sizes) == n + 3000 and max(sizes) < 0.5 * n


def test_heavy_keys(spark):
    rows = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, -5).otherwise(F.col("id")).cast("bigint").alias("key"))
    found = rows.limit(1).select(skew.heavy_keys(rows, "key").alias("k")).collect()[0].k
    assert -5 in found and len(found) < 128
    assert spark.range(1).select(skew.heavy_keys(rows.where("key < -9"), "key").alias("k")).collect()[0].k == []
