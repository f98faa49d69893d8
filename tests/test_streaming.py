import itertools
from datetime import datetime

import pytest
from conftest import collect
from pyspark.sql import functions as F

from corpus_health.operators import health, refresh
from corpus_health.schemas import FILES
from corpus_health.streaming import files as streams
from corpus_health.streaming import metrics

DAY = datetime(2021, 6, 1)


def row(site, path, survey, size, modified=DAY):
    return (site, f"https://t/sites/{site}", "Docs", "Docs", path, size, DAY, modified, "u", "u", False, survey,
            f"/sites/{site}/Docs/{path}")


BATCHES = [
    [row("a", "x.pdf", 1, 10), row("a", "y.doc", 1, 10), row("b", "x.pdf", 1, 5)],
    [row("a", "x.pdf", 2, 30), row("a", "z.pdf", 2, 1)],
    [row("a", "x.pdf", 0, 99), row("c", "x.pdf", 0, 7)],
]
SITES = (
    "site string, site_url string, is_hub boolean, hub_id string, owner string, sharing string, has_retention boolean"
)


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_live_snapshot_in_any_order(spark, frame, tmp_path, order):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    for n in order:
        frame(FILES, *BATCHES[n]).write.mode("append").parquet(landed)
        stream = streams.stream_files(spark, landed)
        streams.stream_snapshot(stream, out, str(tmp_path / "cp"), buckets=4).awaitTermination()
    every = frame(FILES, *itertools.chain(*BATCHES))
    live = streams.read_snapshot(spark, out).select(*every.columns)
    assert collect(live) == collect(refresh.latest_snapshot(every))


def test_deleted_files_leave_snapshot_and_metrics(spark, frame, params, tmp_path):
    landed, out, cp = (str(tmp_path / n) for n in ("landed", "out", "cp"))
    sites = frame(SITES, *[(s, f"https://t/sites/{s}", True, None, "ann", "Disabled", True) for s in "abc"])
    accounts = frame("account string, enabled boolean, is_generic boolean", ("ann", True, False))
    for n, batch in enumerate(BATCHES):
        frame(FILES, *batch).write.mode("append").parquet(landed)
        stream = streams.stream_files(spark, landed)
        query = streams.stream_site_metrics(
            stream, params, out, cp, drop_missing=True, buckets=2
        )
        query.awaitTermination()
        so_far = frame(FILES, *itertools.chain(*BATCHES[: n + 1]))
        want = refresh.latest_snapshot(so_far, drop_missing=True)
        live = streams.read_snapshot(spark, out).select(*so_far.columns)
        assert collect(live) == collect(want)
        metrics = streams.site_metrics(want, sites, accounts, params)
        got = streams.read_metrics(spark, out, sites, accounts, params)
        assert collect(got, "site", "files", "bytes", "health") == collect(metrics, "site", "files", "bytes", "health")
    assert ("a", 2) in collect(got, "site", "files")  # y.doc is gone


def test_a_batch_reads_live_rows_and_not_the_history(spark, frame, tmp_path):
    """Five surveys of the same files: what there is to read does not grow."""
    landed, out, cp = (str(tmp_path / n) for n in ("landed", "out", "cp"))
    sizes = []
    for survey in range(5):
        frame(FILES, *[row("a", f"f{i}.pdf", survey, i) for i in range(50)]).write.mode("append").parquet(landed)
        stream = streams.stream_files(spark, landed)
        streams.stream_snapshot(stream, out, cp, buckets=2).awaitTermination()
        live = streams.read_snapshot(spark, out)
        assert live.count() == 50
        kept = list((tmp_path / "out").rglob("*.parquet"))
        sizes.append((len(live.inputFiles()), len(kept)))
    assert sizes[2][0] == sizes[4][0] and sizes[2][1] == sizes[4][1]


def test_a_batch_writes_what_it_changes(spark, frame, tmp_path):
    """Five batches of a few files into a large site: late, equal and repeated rows cost nothing, changes their own bytes."""
    landed, out, cp = (str(tmp_path / n) for n in ("landed", "out", "cp"))

    def written(*rows):
        frame(FILES, *rows).write.mode("append").parquet(landed)
        before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")}
        streams.stream_snapshot(streams.stream_files(spark, landed), out, cp, buckets=2).awaitTermination()
        new = [p for p in (tmp_path / "out").rglob("*.parquet") if before.get(p) != p.stat().st_mtime_ns]
        return sum(spark.read.parquet(*map(str, new)).count() for _ in new[:1]), sum(p.stat().st_size for p in new)

    many = [row("a", f"f{i}-{hash((i, 'x'))}.pdf", 1, i * 7919 % 100_003) for i in range(20_000)]
    assert written(*many)[0] >= len(many)
    first = sum(p.stat().st_size for p in (tmp_path / "out").rglob("*.parquet"))
    few = [row("a", r[4], 2, r[5] + 1) for r in many[:5]]
    for batch, rows in (
        (few, 5),  # newer
        ([row("a", r[4], 0, 1) for r in many[:3000]], 0),  # late
        (many[:3000] + few, 0),  # known
        (few[:1] * 40 + [row("a", r[4], 3, 5) for r in few[:2]], 2),  # repeated, and two newer
        ([row("b", "new.pdf", 0, 5)], 1),
    ):
        n, size = written(*batch)
        assert n == rows and size < first / 10
    want = {r[-1]: r[5] for r in many} | {r[-1]: r[5] for r in few} | {r[-1]: 5 for r in few[:2]}
    live = {r.path: r.size_bytes for r in streams.read_snapshot(spark, out).where("site = 'a'").collect()}
    assert live == want


def test_a_snapshot_keeps_its_settings(spark, frame, tmp_path):
    landed, out, cp = (str(tmp_path / n) for n in ("landed", "out", "cp"))
    frame(FILES, *BATCHES[0]).write.parquet(landed)
    streams.stream_snapshot(streams.stream_files(spark, landed), out, cp, buckets=2).awaitTermination()
    with pytest.raises(ValueError):
        streams.stream_snapshot(streams.stream_files(spark, landed), out, cp, buckets=4)


def test_no_row_of_an_untouched_site_is_read(spark, frame, params, tmp_path):
    """The files of another bucket are replaced by ones that can't be read, and metrics go on; its sites age all the same."""
    landed, out, cp = (str(tmp_path / n) for n in ("landed", "out", "cp"))
    names = "abcdefgh"
    sites = frame(SITES, *[(s, f"https://t/sites/{s}", True, None, "ann", "Disabled", True) for s in names])
    accounts = frame("account string, enabled boolean, is_generic boolean", ("ann", True, False))
    rows = [row(s, f"{i}.pdf", 1, 10 + i, datetime(2021, 6, 1 + i)) for s in names for i in range(9)]

    def update(*batch):
        frame(FILES, *batch).write.mode("append").parquet(landed)
        streams.stream_site_metrics(streams.stream_files(spark, landed), params, out, cp, buckets=32).awaitTermination()

    update(*rows)
    of = {r.site: r.b for r in sites.select("site", streams.site_bucket(32).alias("b")).collect()}
    assert of["b"] != of["a"]
    for path in (tmp_path / "out" / "files").rglob(f"bucket={of['b']}/**/*.parquet"):
        path.write_bytes(b"nothing")
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    more = [row("a", "0.pdf", 2, 99), row("a", "z.doc", 2, 5)]
    update(*more)
    live = refresh.latest_snapshot(frame(FILES, *rows, *more))
    for day in (params, params.with_(as_of=datetime(2021, 9, 2)), params.with_(as_of=datetime(2021, 9, 5))):
        want = streams.site_metrics(live, sites, accounts, day)
        got = streams.read_metrics(spark, out, sites, accounts, day)
        assert collect(got, *want.columns) == collect(want)
    assert len({r.activity for r in got.collect() if r.site in "ab"}) == 2


def test_signed_cells_are_those_of_the_live_rows(spark, frame, params):
    """Users, libraries, last changes, copies and converted documents are taken back when rows go."""
    new, old = {}, {}
    for i in range(60):
        name = ["x.pdf", "x.doc", "x.docx", "y.xls", "y.xlsx", "big.zip", "img.png"][i % 7]
        old[i] = list(row("ab"[i % 2], f"p{i}", 1, (i % 5) * 10**8, datetime(2021, 1 + i % 6, 3)))
        old[i][4], old[i][9], old[i][2], old[i][3] = name, f"u{i % 4}", ["Docs", "Other"][i % 3 == 0], ["Docs/TMP", "Docs/A"][i % 4 > 0]
        if i % 2:
            new[i] = list(old[i])
            new[i][11], new[i][9], new[i][5], new[i][2], new[i][4] = 2, "u9", 7, "Docs", "x.pdf"
    before, changed = frame(FILES, *map(tuple, old.values())), frame(FILES, *map(tuple, new.values()))
    first = metrics.cells(before.withColumn("sign", F.lit(1)), params)
    for drop in (False, True):
        delta = metrics.cells(streams.signed_changes(changed, before, drop_missing=drop), params)
        after = refresh.latest_snapshot(before.unionByName(changed), drop_missing=drop)
        want = metrics.merged(metrics.cells(after.withColumn("sign", F.lit(1)), params))
        got = metrics.merged(first.unionByName(delta))
        assert collect(got, *want.columns) == collect(want)


def test_site_metrics_follow_the_batches(spark, frame, params, tmp_path):
    landed, out, cp = (str(tmp_path / n) for n in ("landed", "out", "cp"))
    sites = frame(SITES, *[(s, f"https://t/sites/{s}", True, None, "ann", "Disabled", True) for s in "abc"])
    accounts = frame("account string, enabled boolean, is_generic boolean", ("ann", True, False))

    def update():
        stream = streams.stream_files(spark, landed)
        streams.stream_site_metrics(stream, params, out, cp, buckets=4).awaitTermination()
        return collect(streams.read_metrics(spark, out, sites, accounts, params), "site", "files", "bytes", "health")

    for n, batch in enumerate(BATCHES):
        frame(FILES, *batch).write.mode("append").parquet(landed)
        got = update()
        so_far = refresh.latest_snapshot(frame(FILES, *itertools.chain(*BATCHES[: n + 1])))
        metrics = streams.site_metrics(so_far, sites, accounts, params)
        assert got == collect(metrics, "site", "files", "bytes", "health")
    assert update() == got  # nothing new, nothing changes


def test_replayed_batch_changes_nothing(spark, frame, params, tmp_path):
    """A lost checkpoint replays the first batch under the same number."""
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    frame(FILES, *BATCHES[0]).write.parquet(landed)
    for attempt in ("cp1", "cp2"):
        stream = streams.stream_files(spark, landed)
        streams.stream_snapshot(stream, out, str(tmp_path / attempt)).awaitTermination()
    assert streams.read_snapshot(spark, out).count() == 3


def test_landed_rows_arrive_once(spark, frame, tmp_path):
    landed, out, cp = (str(tmp_path / n) for n in ("landed", "out", "cp"))
    for n, batch in enumerate(BATCHES):
        frame(FILES, *batch).write.mode("append").parquet(landed)
        if n != 1:
            streams.land(streams.stream_files(spark, landed), out, cp).awaitTermination()
    assert spark.read.parquet(out).count() == sum(map(len, BATCHES))


def test_index_trend(frame):
    rows = frame("survey_no int, bytes bigint, health double", (1, 1, 10.0), (1, 3, 50.0), (2, 1, 60.0), (4, 1, 55.0))
    assert collect(health.index_trend(rows)) == [(1, 40.0, None), (2, 60.0, 20.0), (4, 55.0, -5.0)]


@pytest.mark.parametrize("run", ["snapshot", "metrics"])
def test_a_batch_writes_few_parts_for_each_bucket(spark, frame, params, tmp_path, run):
    """Each task of the state has rows of every bucket; they meet before they are written, and the stream's settings stay."""
    landed, out, cp = (str(tmp_path / n) for n in ("landed", "out", "cp"))
    rows = [row(s, f"f{i}.pdf", 1, i) for s in "abcdefghijkl" for i in range(40)]
    frame(FILES, *rows).write.parquet(landed)
    stream = streams.stream_files(spark, landed)
    if run == "snapshot":
        query = streams.stream_snapshot(stream, out, cp, buckets=8)
    else:
        query = streams.stream_site_metrics(stream, params, out, cp, buckets=8)
    query.awaitTermination()
    for part in ("files", "cells")[: 1 + (run == "metrics")]:
        found = list((tmp_path / "out" / part / "changes").rglob("*.parquet"))
        buckets = {p.parent for p in found}
        assert len(buckets) > 3 and len(found) < 2 * len(buckets)
    want = frame(FILES, *rows)
    assert collect(streams.read_snapshot(spark, out).select(*want.columns)) == collect(want)


def test_a_batch_leaves_nothing_but_its_changes(spark, frame, tmp_path):
    """What a stream keeps on disk are the rows of its files, once: its checkpoint does not hold them again."""
    landed, out, cp = (str(tmp_path / n) for n in ("landed", "out", "cp"))
    frame(FILES, *[row("a", f"f{i}-{i * 7919 % 10_007}.pdf", 1, i) for i in range(5_000)]).write.parquet(landed)
    streams.stream_snapshot(streams.stream_files(spark, landed), out, cp, buckets=2).awaitTermination()
    size = {n: sum(p.stat().st_size for p in (tmp_path / n).rglob("*") if p.is_file()) for n in ("out", "cp")}
    assert size["cp"] < size["out"] / 4


def test_a_bucket_whose_rows_all_count_is_not_merged(spark, frame, tmp_path):
    """New files are large beside the base, but nothing is gained by writing them again; rows that take a place are merged."""
    landed, out, cp = (str(tmp_path / n) for n in ("landed", "out", "cp"))

    def update(*rows):
        frame(FILES, *rows).write.mode("append").parquet(landed)
        streams.stream_snapshot(streams.stream_files(spark, landed), out, cp, buckets=1).awaitTermination()
        return sorted(p.name for p in (tmp_path / "out" / "files").glob("base/bucket=0/batch_id=*"))

    for n in range(3):
        assert update(*[row("a", f"f{n}-{i}.pdf", 1, i) for i in range(60)]) == []
    assert update(*[row("a", f"f{n}-{i}.pdf", 2, i) for n in range(3) for i in range(60)]) == ["batch_id=3"]
    assert {r.survey_no for r in streams.read_snapshot(spark, out).collect()} == {2}
    assert streams.read_snapshot(spark, out).count() == 180


def _versions(seed):
    """Batches of rows of few files: late, equal, repeated, and of one version with other values or nulls."""
    import random

    draw = random.Random(seed)
    batches = []
    for _ in range(4):
        batch = []
        for _ in range(draw.randrange(60)):
            r = list(row(draw.choice("abc"), f"f{draw.randrange(8)}.pdf", draw.choice([0, 1, 1, 2, 3, None]), draw.randrange(3)))
            r[8], r[9] = draw.choice([(None, "x"), ("x", None), ("x", "x")])  # equal to a hash that passes over nulls
            batch.append(tuple(r))
        batches.append(batch)
    return batches


@pytest.mark.parametrize("drop", [False, True])
def test_changes_of_raw_batches_give_the_snapshot(spark, frame, params, drop):
    """Raw batches, not one row for each file: rows kept and signed cells are those of all rows so far."""
    schema = "site string, site_url string, library string, folder string, file_name string, size_bytes bigint," + (
        " modified_ts timestamp_ntz, path string, created_by string, modified_by string, survey_no int"
    )

    def of(rows):
        made = [(r[0], r[1], r[2], r[3], r[4], r[5], DAY, r[12], r[8], r[9], r[11]) for r in rows]
        return frame(schema, *made)

    batches = _versions(7)
    log, cells, seen = of([]), [], []
    for batch in batches:
        new, old = of(batch), log
        kept = streams.changed_files(new, old, buckets=2).select(*new.columns)
        signed = streams.signed_changes(new, old, drop_missing=drop, buckets=2)
        added = metrics.cells(signed, params)
        cells += [tuple(r) for r in added.collect()]
        log = frame(schema, *[tuple(r) for r in old.unionByName(kept).collect()])
        seen += batch
        want = refresh.latest_snapshot(of(seen), drop_missing=drop)
        assert collect(refresh.latest_snapshot(log, drop_missing=drop), *want.columns) == collect(want)
        sums = metrics.merged(metrics.cells(want.withColumn("sign", F.lit(1)), params))
        assert collect(metrics.merged(frame(added.schema, *cells)), *sums.columns) == collect(sums)
        again = streams.changed_files(new, log, buckets=2)
        assert again.count() == 0  # known


def test_a_survey_lands_as_one_batch(spark, frame, monkeypatch, tmp_path):
    """In no more files than a trigger takes, however many tasks write it."""
    import catalog

    e = catalog.Estate(spark, "nowhere")
    e.files = frame(FILES, *[row("a", f"f{i}.pdf", i % 3, i) for i in range(300)]).repartition(20)
    monkeypatch.setattr(e, "folder", lambda name: str(tmp_path / name), raising=False)
    found = catalog._landed_batches(e)
    assert spark.read.parquet(found).count() == 300
    assert len(list((tmp_path / "landed").glob("*.parquet"))) == 3 * catalog.FILES_PER_TRIGGER
