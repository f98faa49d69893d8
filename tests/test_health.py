"""The index: edges, and the volumes against brute force."""

import random
from collections import defaultdict
from datetime import datetime

import pytest
from conftest import collect
from pyspark.sql import functions as F

from corpus_health.operators import health

MIB = 1024 * 1024
LIMIT = 250 * MIB


def random_rows(n=600, seed=3):
    """Few names, folders and sizes, so that all noise rules meet; site a holds most rows."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        rows.append(
            dict(
                site_url=rng.choice(["https://t/sites/a"] * 8 + ["https://t/sites/b", "https://t/sites/c"]),
                folder=rng.choice(["X", "X/Y", "X/Y/Z", "TMP", "x/superado/k", "", "W"]),
                file_name=rng.choice(["r.doc", "r.docx", "q.xls", "q.xlsx", "p.zip", "n.pdf", "plain"]),
                size_bytes=rng.choice([0, 1, 2, 3, LIMIT, LIMIT + 1]),
                modified_ts=rng.choice([None, datetime(2021, 6, 1), datetime(2015, 1, 1)]),
            )
        )
    return rows


def brute(rows, similar=None):
    """Noise volumes per site by plain loops."""
    ext = lambda r: r["file_name"].rsplit(".", 1)[1] if "." in r["file_name"] else ""
    path = lambda r: f"{r['site_url'][9:]}/{r['folder']}/{r['file_name']}"
    parts = lambda f: set(f.upper().split("/")) - {""}
    out = defaultdict(lambda: dict(dup=0, legacy=0, junk=0, union=0, bytes=0))
    beside = {(r["site_url"], r["folder"], r["file_name"]) for r in rows}
    groups = defaultdict(list)
    for r in rows:
        groups[r["site_url"], r["file_name"], r["size_bytes"]].append(r)
    for (site, name, size), members in groups.items():
        members.sort(key=path)
        first = parts(members[0]["folder"])
        for i, r in enumerate(members):
            here = parts(r["folder"])
            alike = 1.0 if not (here | first) else len(here & first) / len(here | first)
            dup = i > 0 and (similar is None or alike >= similar)
            legacy = (ext(r) == "zip" and size > LIMIT) or (
                ext(r) in ("doc", "xls") and (site, r["folder"], name + "x") not in beside
            )
            junk = bool(parts(r["folder"]) & {"SUPERADO", "BORRADORES", "TMP"})
            o = out[site]
            o["bytes"] += size
            o["dup"] += size * dup
            o["legacy"] += size * legacy
            o["junk"] += size * junk
            o["union"] += size * (dup or legacy or junk)
    return out


def test_volumes_match_brute_force(files, params):
    rows = random_rows()
    expected = brute(rows)
    df = files(*rows)
    scores = {r.site_url: r for r in health.file_scores(df, params).collect()}
    union = {r.site_url: r for r in health.file_scores(df, params, overlap="union").collect()}
    legacy = dict(collect(health.legacy_volume(df)))
    assert scores.keys() == expected.keys()
    for site, e in expected.items():
        s = scores[site]
        assert (s.bytes, s.dup_bytes, s.legacy_bytes, s.junk_bytes) == (
            e["bytes"], e["dup"], e["legacy"], e["junk"]
        )
        assert legacy[site] == e["legacy"]
        assert union[site].noise_bytes == e["union"]
        noise = e["dup"] + e["legacy"] + e["junk"]
        assert s.quality == pytest.approx(max(0, 100 - noise / e["bytes"] * 100))
        assert union[site].quality == pytest.approx(100 - e["union"] / e["bytes"] * 100)
        assert union[site].quality >= s.quality


@pytest.mark.parametrize("similar", [0.0, 0.5, 1.0])
def test_similar_copies_match_brute_force(files, similar):
    rows = random_rows(seed=5)
    expected = {site: e["dup"] for site, e in brute(rows, similar).items()}
    got = dict(collect(health.dup_volume(files(*rows), similar=similar)))
    assert {site: got.get(site, 0) for site in expected} == expected


def test_ownership_takes_the_best_owner(frame):
    sites = frame("site_url string", *[(s,) for s in "abcdef"])
    accounts = frame(
        "account string, enabled boolean, is_generic boolean",
        ("ann", True, False), ("gone", False, False), ("it", True, True), ("oldit", False, True),
    )
    owners = frame(
        "site_url string, owner string",
        ("a", "gone"), ("a", "ann"), ("b", "it"), ("c", "gone"), ("d", None), ("e", "stranger"), ("b", "oldit"),
    )
    assert collect(health.score_ownership(sites, accounts, owners)) == [
        ("a", 100.0), ("b", 50.0), ("c", 0.0), ("d", 0.0), ("e", 0.0), ("f", 0.0)
    ]


def test_stage_edges(frame):
    rows = frame("health double", (0.0,), (35.9,), (36.0,), (69.9,), (70.0,), (100.0,), (None,))
    assert [r.maturity for r in health.maturity(rows).collect()] == [
        "baseline", "baseline", "curation", "curation", "ready", "ready", None
    ]


def test_activity_window_includes_both_ends(files, params):
    df = files(
        dict(modified_ts=datetime(2021, 4, 1), size_bytes=1), dict(modified_ts=datetime(2021, 3, 31, 23, 59), size_bytes=2),
        dict(modified_ts=datetime(2021, 6, 30), size_bytes=4), dict(modified_ts=datetime(2021, 6, 30, 0, 1), size_bytes=8),
        dict(modified_ts=None, size_bytes=16),
    )
    assert collect(health.score_activity(df, params.as_of, 90), "bytes", "active_bytes") == [(31, 5)]


def test_weights_are_checked(params):
    with pytest.raises(ValueError):
        params.with_(weights={**params.weights, "sharing": 0.5})
    with pytest.raises(ValueError):
        health.index({"ownership": 1.0})


def test_site_without_volume_has_no_index_and_no_weight(files, frame, params):
    sites = frame(
        "site string, site_url string, is_hub boolean, hub_id string, owner string, sharing string, has_retention boolean",
        ("A", "https://t/sites/a", True, None, "ann", "Disabled", True), ("B", "u/b", True, None, "ann", "Disabled", True),
        ("C", "u/c", False, None, None, None, None),
    )
    accounts = frame("account string, enabled boolean, is_generic boolean", ("ann", True, False))
    df = files(dict(size_bytes=10), dict(site="B", site_url="u/b", size_bytes=0))
    indexed = health.health_index(df, sites, accounts, params)
    assert collect(indexed, "site_url", "bytes", "health", "maturity") == [
        ("https://t/sites/a", 10, 90.0, "ready"), ("u/b", 0, None, None), ("u/c", 0, None, None)
    ]
    assert collect(health.tenant_index(indexed)) == [(90.0,)]
    assert collect(health.tenant_index(indexed.where("bytes = 0"))) == [(None,)]


def test_half_is_not_stale(files, params):
    old, new = datetime(2015, 1, 1), datetime(2021, 1, 1)
    df = files(
        dict(size_bytes=5, modified_ts=old), dict(size_bytes=5, modified_ts=new),
        dict(site_url="u/b", size_bytes=6, modified_ts=old), dict(site_url="u/b", size_bytes=5, modified_ts=None),
    )
    assert collect(health.stale_sites(df, params.as_of), "site_url") == [("u/b",)]


def test_a_refresh_of_some_sites_moves_the_trend_by_their_change_only(frame):
    rows = frame(
        "survey_no int, site_url string, bytes bigint, health double",
        (1, "a", 10, 50.0), (1, "b", 30, 90.0), (3, "a", 10, 70.0), (4, "c", 20, 10.0), (7, "b", 0, None), (7, None, 5, 99.0),
    )
    kept = collect(health.carried(rows), "survey_no", "site_url", "scored_in", "health")
    assert kept == sorted(
        [(1, "a", 1, 50.0), (1, "b", 1, 90.0), (3, "a", 3, 70.0), (3, "b", 1, 90.0), (4, "a", 3, 70.0), (4, "b", 1, 90.0),
         (4, "c", 4, 10.0), (7, "a", 3, 70.0), (7, "b", 7, None), (7, "c", 4, 10.0)],
        key=str,
    )
    trend = collect(health.estate_trend(rows), "survey_no", "health", "change", "sites", "carried")
    assert trend == [(1, 80.0, None, 2, 0), (3, 85.0, 5.0, 2, 1), (4, 60.0, -25.0, 3, 2), (7, 30.0, -30.0, 3, 2)]
    assert health.estate_trend(rows.limit(0)).count() == 0


def test_every_file_is_listed_unlisted_or_unplaced(frame, files, params):
    rows = files({"size_bytes": 10**9}, {"site_url": "https://t/sites/gone", "size_bytes": 3 * 10**9}, {}, params=params)
    rows = rows.unionByName(rows.limit(1).withColumn("site_url", F.lit(None).cast("string")))
    sites = frame("site_url string", ("https://t/sites/a",), ("https://t/sites/empty",), (None,), ("https://t/sites/a",))
    got = health.reconciliation(rows, sites).collect()[0].asDict()
    assert (got["listed_sites"], got["unlisted_sites"], got["empty_sites"]) == (1, 1, 1)
    assert (got["listed_files"], got["unlisted_files"], got["unplaced_files"]) == (2, 1, 1)
    assert got["unlisted_gb"] == 3.0
    none = health.reconciliation(rows.limit(0), sites).collect()[0]
    assert none.listed_files == 0 and none.listed_gb == 0.0 and none.empty_sites == 2
