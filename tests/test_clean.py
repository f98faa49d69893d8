from datetime import datetime

from conftest import collect
from pyspark.sql import functions as F

from corpus_health.functions import text
from corpus_health.operators import clean
from corpus_health.params import Params


def test_system_rows_go_and_unknown_ones_stay(frame):
    rows = frame(
        "library string, file_name string",
        ("Site Assets", "a"), (None, "b"), ("Docs", None), ("Docs", "__siteIcon__.png"),
        ("site assets", "c"),
    )
    kept = clean.drop_system_files(clean.drop_system_libraries(rows))
    assert collect(kept, "library", "file_name") == [("Docs", None), ("site assets", "c"), (None, "b")]
    assert clean.drop_system_libraries(rows, ["Docs"]).count() == 2


def test_times_of_two_spellings_only(spark, frame):
    rows = frame(
        "created_ts string, modified_ts string",
        ("2001-01-02", "2001-01-02 03:04"), ("31/12/1999", "n/a"), (None, "2001-01"),
        ("2001-02-30", "2021-03-14 02:30"),
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist there
    try:
        got = [tuple(r) for r in clean.parse_times(rows).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [
        (datetime(2001, 1, 2), datetime(2001, 1, 2, 3, 4)), (None, None), (None, None),
        (None, datetime(2021, 3, 14, 2, 30)),
    ]


def test_numbers_fall_back_to_zero(frame):
    rows = frame("size_bytes string, depth string", ("12", "3"), ("n/a", None), (None, "x"))
    assert collect(clean.coerce_numbers(rows)) == [(0, 0), (0, 0), (12, 3)]


def test_activity_flags_are_strict(frame):
    mig = datetime(2020, 1, 1)
    rows = frame(
        "modified_ts timestamp_ntz",
        (mig,), (datetime(2020, 1, 1, 0, 1),), (datetime(2018, 1, 1),),
        (datetime(2017, 12, 31, 23, 59),), (None,),
    )
    flagged = clean.flag_inactive(clean.flag_post(rows, mig), mig, 2)
    assert [(r.is_post, r.is_inactive) for r in flagged.collect()] == [
        (False, False), (True, False), (False, False), (False, True), (False, False)
    ]


def test_leap_day_migration(frame):
    rows = frame("modified_ts timestamp_ntz", (datetime(2023, 2, 27, 23, 59),), (datetime(2023, 2, 28),))
    flagged = clean.flag_inactive(rows, datetime(2024, 2, 29), 1)
    assert [r.is_inactive for r in flagged.collect()] == [True, False]


def test_checkout_column_may_be_absent(frame):
    assert collect(clean.parse_checkout(frame("a int", (1,)))) == [(1, False)]
    marks = frame("checked_out string", ("Sí",), ("No",), (None,))
    assert [r.checked_out for r in clean.parse_checkout(marks).collect()] == [True, False, False]


def test_categories_ignore_case_and_default(frame):
    rows = frame("ext string", ("PDF",), ("xlsm",), ("7z",), ("",), (None,), ("unknown",))
    assert [r.category for r in clean.categorize(rows).collect()] == [
        "PDF", "Excel / Datos", "Comprimido", "Otro", "Otro", "Otro"
    ]


def test_special_formats(frame):
    rows = frame("ext string", ("dwg",), ("pdf",), (None,), ("7z",))
    assert collect(clean.special_formats(rows), "ext", "label") == [
        ("7z", "Comprimido"), ("dwg", "CAD / Planos")
    ]


def test_paths(frame):
    url = "https://t.example/sites/a+b(1)/"
    rows = frame(
        "site_url string, path string, file_name string",
        (url, "/sites/A+B(1)/Docs/x/f.pdf", "f.pdf"),
        (url, "/sites/a+b(1)/f.pdf", "f.pdf"),
        (url, "/sites/a+b(1)x/f.pdf", "f.pdf"),
        (url, None, "f.pdf"),
        ("https://t.example", "/Docs/F.PDF", "f.pdf"),
    )
    got = [(r.rel_path, r.folder, r.depth) for r in clean.relative_path(rows).collect()]
    assert got == [
        ("Docs/x/f.pdf", "Docs/x", 2),
        ("f.pdf", "", 0),  # directly under the site
        ("/sites/a+b(1)x/f.pdf", "/sites/a+b(1)x", 3),
        (None, None, 0),
        ("Docs/F.PDF", "Docs", 1),
    ]


def test_top_folder(frame):
    rows = frame(
        "folder string",
        ("Documents/A/B",), ("Shared Documents",), (None,), ("",), ("/Documents/Documents/X",), ("B/B/A",),
    )
    assert [r.top_folder for r in clean.top_folder(rows).collect()] == [
        "A", "(raíz)", "(raíz)", "(raíz)", "X", "B"
    ]


def test_sizes_round_half_to_even(frame):
    rows = frame("size_bytes bigint", (131072,), (393216,), (0,), (1536,))
    assert collect(clean.size_units(rows)) == [
        (0, 0.0, 0.0), (131072, 128.0, 0.12), (1536, 1.5, 0.0), (393216, 384.0, 0.38)
    ]


def test_names(frame):
    rows = frame("site string", ("GR- Ñandú  & Co__x",), ("b" * 60,))
    assert [r.slug for r in clean.site_slug(rows).collect()] == ["GR-_and_Co_x", "b" * 50]
    assert clean.site_filter(rows, "ñANDÚ").count() == 1
    parts = frame("file_name string", ("a.b.PDF",), ("none",), ("x.",), (None,))
    got = parts.select(text.file_ext(F.col("file_name")), text.file_stem(F.col("file_name")))
    assert [tuple(r) for r in got.collect()] == [("pdf", "a.b"), ("", "none"), ("", "x"), ("", None)]


def test_params_from_config():
    config = {
        "cliente": {"nombre": "N", "tenant_prefix": "t", "carpeta_local": "/x"},
        "fechas": {"migracion": "2020-02-03"},
        "sitios_excluidos": [{"id": "s1"}],
    }
    p = Params.from_config(config)
    assert (p.migrated_at, p.inactive_years, p.excluded_ids) == (datetime(2020, 2, 3), 2, ("s1",))
    for bad in ({**config, "cliente": {}}, {**config, "fechas": {"migracion": ""}}):
        try:
            Params.from_config(bad)
            raise AssertionError("accepted")
        except ValueError:
            pass
