from datetime import datetime
from pathlib import Path

import pytest
from conftest import collect
from pyspark.sql import functions as F

from corpus_health.operators import clean
from corpus_health.schemas import INVENTORY_COLUMNS, REQUIRED_SURVEY_COLUMNS, RUN_COLUMNS, SURVEY_COLUMNS
from corpus_health.sources import inventory, manifest, sinks, surveys
from corpus_health.sources.shared import work_dir

HEADER = list(SURVEY_COLUMNS)
ROW = {
    "Sitio": "A", "URL_Sitio": "https://t/sites/a", "Biblioteca": "Docs", "Nombre_Archivo": "NA",
    "Tamaño_Bytes": "5", "Fecha_Modificacion": "2021-01-02 03:04", "Extension": "",
}


def write(folder, name, header, *rows, bom=False, tail=""):
    quote = lambda v: '"' + v.replace('"', '""') + '"'
    lines = [",".join(quote(h) for h in header)]
    lines += [",".join(quote(r.get(h, "")) for h in header) for r in rows]
    text = ("﻿" if bom else "") + "\r\n".join(lines) + "\r\n" + tail
    (folder / name).write_bytes(text.encode("utf-8"))


@pytest.fixture
def folder(tmp_path):
    tmp_path = tmp_path / "año 1+2 %"  # paths are not URLs
    tmp_path.mkdir()
    write(tmp_path, "Cl_B_Docs_North_20210101_080000.csv", HEADER, ROW, {**ROW, "Nombre_Archivo": 'a,"b"'}, bom=True)
    old = [h for h in HEADER[::-1] if h not in ("Archivo_Bloqueado", "Profundidad_Carpeta")]
    write(tmp_path, "Cl_B_Docs_Resumen_20210102_080000.csv", old, {**ROW, "Sitio": "B", "Biblioteca": ""})
    write(tmp_path, "Other_Relevamiento_X_20210103_080000.csv", HEADER, {**ROW, "Sitio": "O"}, tail='"too","few"\r\n')
    write(tmp_path, "Cl_B_Docs_Bad_20210104_080000.csv", ["Nombre_Archivo", "x"], ROW)
    (tmp_path / "Cl_B_Docs_Empty_20210104_080000.csv").write_bytes(b"")  # no rows, listed as such
    write(tmp_path, "Cl_B_Masivo_Resumen_20210104_080000.csv", HEADER, ROW)
    write(tmp_path, "Cl_CONSOLIDADO_B_Docs_All_20210104_080000.csv", HEADER, ROW)
    write(tmp_path, "Cl_Relevamiento_X_20210104_080000_LOG.csv", HEADER, ROW)
    return str(tmp_path)


def test_files_are_found_by_name_and_checked_by_header(spark, folder):
    found = surveys.survey_files(spark, folder)
    names = {r.path.rsplit("/", 1)[1]: r.problem for r in found.collect()}
    assert names == {
        "Cl_B_Docs_North_20210101_080000.csv": None,
        "Cl_B_Docs_Resumen_20210102_080000.csv": None,
        "Other_Relevamiento_X_20210103_080000.csv": None,
        "Cl_B_Docs_Bad_20210104_080000.csv": "missing columns: Sitio, URL_Sitio, Biblioteca",
        "Cl_B_Docs_Empty_20210104_080000.csv": "empty file",
    }
    assert surveys.survey_files(spark, folder, "Other").count() == 1


def test_columns_are_matched_by_name(spark, folder, params):
    raw = surveys.read_surveys(spark, folder, "Cl")
    assert collect(raw, "site", "library", "file_name", "size_bytes", "ext", "checked_out", "survey_ts") == [
        ("A", "Docs", "NA", "5", None, None, datetime(2021, 1, 1, 8)),
        ("A", "Docs", 'a,"b"', "5", None, None, datetime(2021, 1, 1, 8)),
        ("B", None, "NA", "5", None, None, datetime(2021, 1, 2, 8)),
    ]
    ready = clean.clean(raw, params)
    assert collect(ready, "size_bytes", "modified_ts", "checked_out", "is_post")[0] == (
        5, datetime(2021, 1, 2, 3, 4), False, True
    )


def test_rows_that_do_not_fit_are_kept_apart(spark, folder):
    good, bad = surveys.quarantine(surveys.read_surveys(spark, folder))
    assert (good.count(), bad.count()) == (4, 1)
    assert [r.line for r in bad.collect()] == ['"too","few"']


def test_no_surveys_is_an_error(spark, tmp_path):
    write(tmp_path, "x.csv", HEADER, ROW)
    with pytest.raises(FileNotFoundError):
        surveys.read_surveys(spark, str(tmp_path))


def test_union_keeps_names(frame):
    both = surveys.union_surveys([frame("a int, b int", (1, 2)), frame("b int, c int", (3, 4))])
    assert collect(both, "a", "b", "c") == [(1, 2, None), (None, 3, 4)]


def test_write_files_appends_by_date(spark, frame, tmp_path):
    out = str(tmp_path / "out")
    ddl = "site_url string, path string, survey_date string"
    sinks.write_files(frame(ddl, ("a", "p", "2021-01-01"), ("b", "q", "2021-01-01")), out)
    sinks.write_files(frame(ddl, ("a", "p", "2021-01-02")), out)
    assert spark.read.parquet(out).groupBy("survey_date").count().count() == 2
    assert spark.read.parquet(out).count() == 3


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = work_dir(spark, "x"), work_dir(spark, "x")
    assert one != two and one.startswith(base)


def test_shared_folder_is_the_warehouse_where_none_is_set():
    class Session:
        class conf:
            get = staticmethod({"spark.sql.warehouse.dir": "/house/"}.get)

    assert work_dir(Session, "x").startswith("/house/x-")


def test_files_that_cannot_be_read_are_listed(spark, folder):
    found = {r.path.rsplit("/", 1)[1]: r.problem for r in surveys.bad_files(spark, folder).collect()}
    assert found == {
        "Cl_B_Docs_Bad_20210104_080000.csv": "missing columns: Sitio, URL_Sitio, Biblioteca",
        "Cl_B_Docs_Empty_20210104_080000.csv": "empty file",
    }


def test_known_headers_are_not_read_again(spark, folder, tmp_path, monkeypatch):
    at, opened = str(tmp_path / "manifest"), []
    read = manifest.headers
    monkeypatch.setattr(manifest, "headers", lambda s, paths: opened.append({p.rsplit("/", 1)[1] for p in paths}) or read(s, paths))
    first = collect(surveys.read_surveys(spark, folder, "Cl", at))
    assert len(opened.pop()) == 3
    assert collect(surveys.read_surveys(spark, folder, "Cl", at)) == first and not opened
    place = Path(folder)
    write(place, "Cl_B_Docs_New_20210105_080000.csv", HEADER[::-1], {**ROW, "Sitio": "N"})
    write(place, "Cl_B_Docs_Bad_20210104_080000.csv", HEADER, {**ROW, "Sitio": "mended"})  # changed: read again
    sites = {r.site for r in surveys.read_surveys(spark, folder, "Cl", at).collect()}
    assert opened == [{"Cl_B_Docs_New_20210105_080000.csv", "Cl_B_Docs_Bad_20210104_080000.csv"}]
    assert sites == {"A", "B", "N", "mended"}
    (place / "Cl_B_Docs_New_20210105_080000.csv").unlink()
    assert "N" not in {r.site for r in surveys.read_surveys(spark, folder, "Cl", at).collect()}


def test_lines_of_inventories_and_runs_that_do_not_fit(spark, tmp_path):
    def lines(name, columns, *rows):
        head = ",".join(f'"{n}"' for n in columns)
        (tmp_path / name).write_text("\n".join([head, *rows]) + "\n", encoding="utf-8")

    fits = lambda columns, first: ",".join([f'"{first}"'] + ['""'] * (len(columns) - 1))
    lines("Cl_A_Inventario_Sitios_20210101_080000.csv", INVENTORY_COLUMNS, fits(INVENTORY_COLUMNS, "a"), '"cut","https', fits(INVENTORY_COLUMNS, "b"))
    lines("Cl_B_Masivo_Resumen_20210101_080000.csv", RUN_COLUMNS, fits(RUN_COLUMNS, "1"), fits(RUN_COLUMNS, "2") + ',"more"')
    assert collect(inventory.read_inventory(spark, str(tmp_path), "Cl"), "site") == [("a",), ("b",)]
    assert collect(inventory.read_runs(spark, str(tmp_path), "Cl"), "run_order") == [(1,)]
    bad = inventory.bad_lines(spark, str(tmp_path), "Cl")
    assert collect(bad, "kind", "line") == [("inventory", '"cut","https'), ("run", fits(RUN_COLUMNS, "2") + ',"more"')]
    assert collect(bad.where("source_file LIKE '%Resumen_20210101%'"), "kind") == [("run",)]
    assert inventory.bad_lines(spark, str(tmp_path), "Nobody").count() == 0


def test_landing_again_changes_nothing(spark, frame, tmp_path):
    out, ddl = str(tmp_path / "out"), "site_url string, path string, survey_date string"
    for _ in range(2):
        sinks.write_files(frame(ddl, ("a", "p", "2021-01-01"), ("b", "q", "2021-01-02")), out)
    sinks.write_files(frame(ddl, ("a", "r", "2021-01-01")), out)
    assert collect(spark.read.parquet(out), "site_url", "path") == [("a", "r"), ("b", "q")]


def test_zero_in_the_configuration_stays():
    from corpus_health import Params

    client = {"cliente": {"nombre": "a", "tenant_prefix": "b", "carpeta_local": "c"}}
    zeros = Params.from_config(
        client
        | {"fechas": {"inactividad_anios": 0}, "refresh": {"dias_umbral": 0}}
        | {"clasificacion": {"gb_principal": 0, "gb_mediano": 0, "mb_archivo_grande": 0}}
    )
    assert (zeros.inactive_years, zeros.refresh_days, zeros.main_gb, zeros.mid_gb, zeros.large_mb) == (0, 0, 0, 0, 0)
    plain = Params.from_config(client | {"fechas": {"inactividad_anios": None}})
    assert (plain.inactive_years, plain.refresh_days, plain.large_mb) == (2, 7, 100)
    with pytest.raises(ValueError, match="as_of"):
        plain.today


def test_one_site_and_one_file_are_found_without_reading_the_rest(spark, tmp_path):
    """Three dates, one site with half of the rows: lookups read a small part of the bytes, and the site lies in several files."""
    out = str(tmp_path / "out")
    i = F.col("id")
    rows = spark.range(400_000).select(
        F.when(i % 2 == 0, "https://t/sites/hot").otherwise(F.concat(F.lit("https://t/sites/s"), i % 501)).alias("site_url"),
        F.concat(F.lit("/docs/"), F.md5(i.cast("string"))).alias("path"),
        F.md5((i + 7).cast("string")).alias("note"),
        F.concat(F.lit("2021-01-0"), i % 3 + 1).alias("survey_date"),
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        sinks.write_files(rows, out)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = spark.read.parquet(out)
    hot = files.where("site_url = 'https://t/sites/hot'").select(F.input_file_name()).distinct().count()
    assert hot > 3  # more than one for each date
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.hadoop.vectored.io.enabled", "false")  # whose bytes are not counted
    statistics = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem

    def read(df):
        count = lambda: sum(s.getBytesRead() for s in statistics.getAllStatistics() if s.getScheme() == "file")
        before = count()
        found = df.collect()
        return found, count() - before

    every, all_bytes = read(files.select("note", "path", "site_url").where("length(note) < 3"))
    path = files.where("site_url = 'https://t/sites/hot'").limit(1).collect()[0].path
    one, bytes_of_one = read(sinks.read_files(spark, out, path=path).select("note", "path"))
    site, bytes_of_site = read(sinks.read_files(spark, out, "https://t/sites/s77").select("note", "path"))
    none, bytes_of_none = read(sinks.read_files(spark, out, "https://t/sites/s77", path))
    hadoop.unset("parquet.hadoop.vectored.io.enabled")
    assert (len(every), len(one), len(none)) == (0, 1, 0)
    assert len(site) == rows.where("site_url = 'https://t/sites/s77'").count()
    assert bytes_of_one < all_bytes / 5 and bytes_of_site < all_bytes / 5 and bytes_of_none < all_bytes / 5


def test_ingested_files_are_not_made_again_by_each_use(spark, folder, params):
    files, rows, _ = surveys.ingest(spark, str(folder), params)
    plan = files._jdf.queryExecution().toString()
    assert "Window" not in plan and "Scan csv" not in plan and "Scan parquet" in plan
    assert files.count() > 0


def test_packed_surveys_are_read_like_plain_ones(spark, tmp_path):
    """Single files and folders of parts, one without a byte; a header of its own is found in packed lines too."""
    import gzip

    write(tmp_path, "Cl_B_Docs_North_20210101_080000.csv", HEADER, ROW, {**ROW, "Nombre_Archivo": 'a,"b"'}, bom=True)
    write(tmp_path, "South.csv", HEADER[::-1], {**ROW, "Sitio": "S"}, tail='"too","few"\r\n')
    packed = tmp_path / "Cl_B_Docs_South_20210102_080000.csv.gz"
    packed.write_bytes(gzip.compress((tmp_path / "South.csv").read_bytes()))
    part = tmp_path / "Cl_B_Docs_West_20210103_080000.csv"
    part.mkdir()
    write(tmp_path, "West.csv", HEADER, {**ROW, "Sitio": "W"})
    (part / "part-00000-x.csv.gz").write_bytes(gzip.compress((tmp_path / "West.csv").read_bytes()))
    (tmp_path / "Cl_B_Docs_Void_20210104_080000.csv.gz").write_bytes(b"")
    good, bad = surveys.quarantine(surveys.read_surveys(spark, str(tmp_path), "Cl"))
    assert collect(good, "site", "file_name", "survey_ts") == [
        ("A", "NA", datetime(2021, 1, 1, 8)), ("A", 'a,"b"', datetime(2021, 1, 1, 8)),
        ("S", "NA", datetime(2021, 1, 2, 8)), ("W", "NA", datetime(2021, 1, 3, 8)),
    ]
    assert [r.line for r in bad.collect()] == ['"too","few"']
    assert [r.path.rsplit("/", 1)[1] for r in surveys.bad_files(spark, str(tmp_path), "Cl").collect()] == [
        "Cl_B_Docs_Void_20210104_080000.csv.gz"
    ]


def test_paths_are_looked_at_once_a_file(spark, tmp_path):
    """The run time of a row is looked for in the end of its path, and a path is decoded for its header only."""
    name = "Client_B_Docs_A_20200101_000000.csv"  # a folder with a name like the survey's in front of it
    names = [theirs for theirs, ours in SURVEY_COLUMNS.items() if ours in REQUIRED_SURVEY_COLUMNS]
    folder = tmp_path / "Old_20190101_000000.csv" / "x"
    for at in (folder / "Client_B_Docs_A_20210102_030405.csv" / "part-1_20220101_000000.csv", folder / "a b+c" / name):
        at.parent.mkdir(parents=True)
        at.write_text(",".join(names) + "\n" + ",".join("1" for _ in names) + "\n")
    rows = surveys.read_surveys(spark, str(tmp_path))
    assert sorted(str(r.survey_ts) for r in rows.collect()) == ["2020-01-01 00:00:00", "2021-01-02 03:04:05"]
    assert surveys.SURVEY_PATH not in rows._jdf.queryExecution().analyzed().toString()
    paths = [str(p) for p in tmp_path.rglob("*.csv") if p.is_file()]
    found = manifest.headers(spark, paths)
    assert {r.path for r in found.collect()} == {f"file://{p}" for p in paths}
    assert {r.header for r in found.collect()} == {",".join(names)}
    grouped, _, below = found._jdf.queryExecution().optimizedPlan().toString().partition("Aggregate")[2].partition("\n")
    assert "decode" in grouped and "decode" not in below
