"""Plans of the registered queries: what must and must not be in them."""

import pytest

import catalog

# these write tables first, so their result is only a read
EAGER = ("i1_", "i3_quarantine", "i3_bad_files", "i4_read", "i6_", "i7_", "r5_bad_lines", "s19_", "st", "t6_")
LAZY = [name for name in catalog.QUERIES if not name.startswith(EAGER)]


@pytest.fixture(scope="module")
def plan(spark):
    estate = catalog.Estate(spark, "/root/testdata/sf0.001")

    def text(name):
        return catalog.QUERIES[name].run(estate)._jdf.queryExecution().toString()

    return text


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(plan, name):
    physical = plan(name).split("== Physical Plan ==")[1]
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in physical, node


@pytest.mark.parametrize("name", ["s5_site_extensions", "s7_large_files", "s13_site_users", "s17_site_recent_post", "r7_latest_snapshot"])
def test_groups_are_trimmed_before_the_shuffle(plan, name):
    assert "Partial" in plan(name) and "WindowGroupLimit" in plan(name)


@pytest.mark.parametrize("name", ["t8_top_users", "t9_post_sample", "t10_inactive_files"])
def test_top_rows_are_not_sorted_as_a_whole(plan, name):
    assert "TakeOrderedAndProject" in plan(name)


@pytest.mark.parametrize("name", ["t1_corpus_totals", "t2_site_summary", "s1_site_profile", "s5_site_extensions"])
def test_files_are_read_once(plan, name):
    physical = plan(name).split("== Physical Plan ==")[1]
    scans = [line for line in physical.splitlines() if "FileScan" in line and "lineitem" in line]
    assert len(scans) == 1


def test_only_needed_columns_are_read(spark, tmp_path):
    from corpus_health.operators import clean, site

    estate = catalog.Estate(spark, "/root/testdata/sf0.001")
    estate.files.write.parquet(str(tmp_path / "files"))
    landed = clean.enrich(spark.read.parquet(str(tmp_path / "files")), catalog.PARAMS)
    text = site.duplicates(landed)._jdf.queryExecution().toString()
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {"site_url", "library", "file_name", "size_bytes"}
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    large = site.large_files(landed)._jdf.queryExecution().toString()
    assert "GreaterThan(size_bytes,104857600)" in large


def final_scans(df):
    """Scans of the plan that ran, shared stages counted once."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return sum("FileScan" in line for line in final.splitlines())


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    estate = catalog.Estate(spark, "/root/testdata/sf0.001")
    folder = str(tmp_path_factory.mktemp("plans") / "clean")
    estate.clean.write.parquet(folder)
    return spark.read.parquet(folder)


def scans_of(df, folder):
    """Scans of a folder in a plan as it stands, those in subqueries too."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return sum("Location" in line and folder in line for line in text.splitlines())


def test_report_reads_the_files_twice(landed, monkeypatch):
    """Once for the cells, once for the lists; all else reads cells."""
    from corpus_health.plans import report, store

    folder = landed.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    landing = []

    def watched(files, params):
        landing.append(scans_of(store.summed(files, params), folder))
        return land(files, params)

    land = store.land
    monkeypatch.setattr(store, "land", watched)
    done = report.site_report(landed, catalog.PARAMS)
    assert landing == [1] and scans_of(done, folder) == 1


def test_archive_candidates_read_the_files_once(landed, spark, monkeypatch):
    from corpus_health.operators import tenant

    folder = landed.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    land, landing = tenant.landed, []
    monkeypatch.setattr(tenant, "landed", lambda df, name: landing.append(scans_of(df, folder)) or land(df, name))
    found = tenant.archive_candidates(tenant.site_summary(landed))
    assert landing == [1] and scans_of(found, folder) == 0


@pytest.mark.parametrize("name", ["t1_corpus_totals", "t2_site_summary", "t7_category_stats"])
def test_files_are_scanned_once_with_subqueries(spark, landed, name):
    folder = landed.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    estate = catalog.Estate(spark, "/root/testdata/sf0.001")
    estate.__dict__["clean"] = landed
    assert scans_of(catalog.QUERIES[name].run(estate), folder) == 1


def test_union_of_noise_reads_the_files_twice_and_repeats_nothing(landed):
    from corpus_health.operators import health

    union = health.score_quality(landed, catalog.PARAMS, overlap="union")
    assert final_scans(union) <= 2
    similar = health.dup_volume(landed, similar=0.5)
    for df in (union, similar):
        assert "Generate" not in df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["c3_parse_times", "i5_normalize_listing", "s9_duplicates"])
def test_files_are_joined_once_for_all_queries(plan, name):
    physical = plan(name).split("== Physical Plan ==")[1]
    assert "Join" not in physical


def test_rows_of_a_site_meet_before_they_are_added_up(files):
    from corpus_health.plans import store

    logical = store.summed(files({}), catalog.PARAMS)._jdf.queryExecution().optimizedPlan().toString()
    below = logical[logical.index("Expand"):]
    assert "RebalancePartitions [site_url" in below


def test_rows_of_a_site_meet_before_they_are_summarized(files):
    from corpus_health.operators import clean, tenant

    summary = tenant.site_summary(clean.enrich(files({}), catalog.PARAMS))
    logical = summary._jdf.queryExecution().optimizedPlan().toString()
    below = logical[logical.index("Expand"):]
    assert "RebalancePartitions [site_url" in below
    assert "folder" not in below[: below.index("RebalancePartitions")] and "created_by" not in logical.split("Rebalance")[0]
