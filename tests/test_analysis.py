"""Estate, portfolio and per-site sections on hand-made rows."""

from datetime import datetime

from conftest import collect
from pyspark.sql import functions as F

from corpus_health.operators import portfolio, site, tenant

POST, PRE = datetime(2020, 6, 1), datetime(2019, 6, 1)
MIB = 1024 * 1024


def test_totals_of_nothing(files):
    empty = files(dict()).where("false")
    row = tenant.corpus_totals(empty).collect()[0]
    assert (row.files, row.gb, row.sites, row.post, row.pct_post, row.users) == (0, 0.0, 0, 0, 0.0, 0)


def test_unknown_keys_count_in_totals_only(files):
    df = files(
        dict(site=None, modified_by=None, size_bytes=10), dict(size_bytes=20), dict(library=None, size_bytes=30)
    )
    total = tenant.corpus_totals(df).collect()[0]
    assert (total.files, total.sites, total.users, total.gb) == (3, 1, 1, 60 / 1e9)
    summary = tenant.site_summary(df).collect()
    assert [(r.files, r.bytes, r.users, r.libraries) for r in summary] == [(2, 50, 1, 1)]
    assert [r.modified_by for r in tenant.top_users(df).collect()] == ["u"]


def test_recommendation_edges(frame):
    rows = frame("post bigint, files bigint", (0, 10), (3, 10), (29, 100), (30, 100), (1, 1000))
    got = [r.recommendation for r in tenant.recommend(rows).collect()]
    assert got == ["Archivar", "Activo — revisar destino", "Revisar", "Activo — revisar destino", "Revisar"]
    assert [r.severity for r in tenant.activity_colour(rows).collect()] == [
        "critical", "ok", "warning", "ok", "warning"
    ]
    assert [r.status for r in site.site_status(rows).collect()] == [
        "CANDIDATO A ARCHIVO", "ACTIVO POST-MIGRACIÓN", "ACTIVIDAD BAJA", "ACTIVO POST-MIGRACIÓN",
        "ACTIVIDAD BAJA",
    ]


def test_top_category_ties_and_gaps(files):
    df = files(dict(file_name="a.pdf"), dict(file_name="b.docx"), dict(site="B", site_url="u/b"))
    none = df.withColumn("category", F.when(F.col("site") == "A", F.col("category")))
    assert collect(tenant.top_category(df), "site", "top_category") == [("A", "PDF"), ("B", "PDF")]
    assert collect(tenant.top_category(none), "site", "top_category") == [("A", "PDF"), ("B", None)]
    assert collect(tenant.site_summary(none), "site", "top_category") == [("A", "PDF"), ("B", None)]


def test_band_edges(frame):
    rows = frame("gb double", (10.0,), (9.999,), (1.0,), (0.999,))
    assert [r.band for r in portfolio.size_band(rows).collect()] == ["main", "mid", "mid", "minor"]


def test_first_listed_report_wins(frame):
    summary = frame("site_url string", ("a",), ("b",), ("c",), ("d",))
    reports = frame(
        "ordinal bigint, site_url string, artifact string, destination string",
        (2, "a", "second", "x"), (1, "a", "first", "x"), (3, "b", "missing", "x"),
    )
    artifacts = frame(
        "site_url string, artifact string, written_ts timestamp_ntz",
        ("a", "first", POST), ("a", "auto", POST), ("b", "auto_b", POST), ("c", "old", PRE), ("c", "new", POST),
    )
    coverage = portfolio.report_coverage(summary, reports, artifacts)
    assert collect(coverage, "site_url", "report", "report_kind") == [
        ("a", "first", "prioritario"), ("b", "missing", "prioritario_faltante"),
        ("c", "new", "automatico"), ("d", None, None),
    ]


def test_duplicates_need_size_and_same_site(files):
    df = files(
        dict(size_bytes=5), dict(size_bytes=5, folder="Y"), dict(size_bytes=0), dict(size_bytes=0),
        dict(size_bytes=5, site="B", site_url="u/b"), dict(size_bytes=6),
    )
    dups = site.duplicates(df)
    assert collect(dups, "file_name", "copies", "extra_bytes") == [("f.pdf", 2, 5)]
    assert site.top_duplicates(dups).count() == 0  # below the reporting gate


def test_limits_are_exclusive(files):
    df = files(
        dict(file_name="a.zip", size_bytes=250 * MIB), dict(file_name="b.zip", size_bytes=250 * MIB + 1),
        dict(file_name="c.rar", size_bytes=300 * MIB), dict(file_name="d.bin", size_bytes=100 * MIB),
    )
    assert collect(site.oversize_archives(df), "file_name") == [("b.zip",)]
    assert collect(site.large_files(df), "rank", "file_name", "over_limit") == [
        (1, "c.rar", True), (2, "b.zip", True), (3, "a.zip", False)
    ]


def test_format_alerts(files):
    df = files(
        dict(file_name="a.zip", size_bytes=250_000_000), dict(file_name="a.rar", size_bytes=250_000_001),
        dict(file_name="a.heic"), dict(file_name="a.mov"), dict(file_name="a.dwg"), dict(file_name="a.pdf"),
    )
    assert collect(site.site_special_formats(df), "ext", "alert") == [
        ("dwg", "Revisar"), ("heic", "Atención requerida"), ("mov", "Evaluar Azure Blob"),
        ("rar", "Verificar límite SPMT"), ("zip", "Revisar"),
    ]


def test_rows_without_extension_count_in_the_site_only(files):
    df = files(dict(file_name="none", size_bytes=30), dict(size_bytes=10))
    assert collect(site.site_extensions(df), "ext", "files", "pct_gb") == [("pdf", 1, 25.0)]


def test_years(files):
    df = files(dict(modified_ts=PRE), dict(modified_ts=PRE), dict(modified_ts=POST), dict(modified_ts=None))
    assert collect(site.activity_by_year(df, datetime(2020, 5, 1)), "year", "files", "width", "is_post") == [
        (2019, 2, 100.0, False), (2020, 1, 50.0, True)
    ]


def test_decisions_are_numbered_without_gaps(files):
    df = files(
        dict(file_name="a.xlsb"), dict(file_name="a.mp4", size_bytes=10**9),
        dict(file_name="x.pdf", size_bytes=10**9, folder="1"), dict(file_name="x.pdf", size_bytes=10**9, folder="2"),
        dict(site="B", site_url="u/b"),
        dict(site="C", site_url="u/c", file_name="m.xlsm"), dict(site="C", site_url="u/c", file_name="m.xlsb"),
    )
    assert collect(site.decisions(df), "site_url", "num", "subject", "n") == [
        ("https://t/sites/a", 1, "xlsb", 1), ("https://t/sites/a", 2, "video", 1),  # 1 GB is not above the gate
        ("u/b", 1, "none", 0), ("u/c", 1, "xlsm", 1),
    ]


def test_report_shows_what_the_sections_show(spark, params):
    import catalog
    from corpus_health.plans.report import site_report

    e = catalog.Estate(spark, "/root/testdata/sf0.001")
    clean = e.clean.cache()
    report = site_report(clean, catalog.PARAMS).cache()
    sections = {
        "categories": site.site_categories(clean).drop("rank"),
        "extensions": site.site_extensions(clean),
        "special_formats": site.site_special_formats(clean),
        "years": site.activity_by_year(clean, catalog.PARAMS.migrated_at),
        "top_users": site.site_users(clean),
        "folders": site.site_folders(clean),
        "large_files": site.large_files(clean),
        "recent_post": site.site_recent_post(clean),
        "top_duplicates": site.top_duplicates(site.duplicates(clean)),
        "decisions": site.decisions(clean),
    }
    for name, section in sections.items():
        shown = report.select("site_url", F.inline(name))
        fields = sorted(section.columns)
        assert sorted(shown.columns) == fields, name
        assert collect(shown, *fields) == collect(section, *fields), name
    profile = site.site_status(site.site_profile(clean))
    fields = sorted(profile.columns)
    assert collect(report, *fields) == collect(profile, *fields)
    clean.unpersist()
    report.unpersist()
