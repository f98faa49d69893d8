"""Inventory and refresh."""

from datetime import datetime

from conftest import collect

from corpus_health.operators import inventory, refresh

SITES = (
    "site string, site_url string, template string, is_hub boolean, hub_id string, storage_mb double,"
    " owner string, lock_state string, last_activity_ts timestamp_ntz"
)
NO_ID = "00000000-0000-0000-0000-000000000000"


def site(frame, *rows):
    plain = dict(
        site="S", site_url="https://t/s", template="STS#3", is_hub=False, hub_id=NO_ID,
        storage_mb=2048.0, owner="o", lock_state="Unlock", last_activity_ts=None,
    )
    return frame(SITES, *[tuple({**plain, **r}.values()) for r in rows])


def test_first_class_rule_wins(frame):
    rows = site(
        frame,
        dict(site="1", template="group#2", is_hub=True),
        dict(site="GR-2", template="STS#0"),
        dict(site="3", site_url="https://T/root/", is_hub=True),
        dict(site="4", is_hub=True, hub_id="h"),
        dict(site="5", hub_id="h"),
        dict(site="6", hub_id=""),
        dict(site="7", template=None, hub_id=None),
    )
    classed = inventory.site_class(rows, "https://t/root", ["gr-"])
    assert [r.site_class for r in classed.collect()] == [
        "Legacy (Teams)", "Legacy (Teams)", "Hub Site (raiz)", "Hub Site",
        "Spoke Site (Hub asociado)", "Sitio independiente", "Sitio independiente",
    ]


def test_legacy_by_class_differs_from_legacy_by_template(frame):
    rows = site(frame, dict(template="GROUP#2"), dict(template="teamchannel#1"), dict(site="Eq-1"))
    assert [r.is_legacy for r in inventory.is_legacy(rows, prefixes=["EQ-"]).collect()] == [
        False, True, True
    ]


def test_site_types(frame):
    rows = site(frame, *[dict(template=t) for t in ("GROUP#0", "sts#1", "TEAMCHANNEL#0", "EHS#1", None)])
    assert [r.site_type for r in inventory.site_type(rows).collect()] == [
        "Team Site (M365 Group)", "Team Site (clásico)", "Canal de Teams", "EHS#1", None
    ]


def test_exclusions_and_backlog(frame, params):
    inv = frame(
        "site string, site_url string, template string, site_type string, lock_state string, storage_gb string",
        ("a", "u/1", "GROUP#0", "x", "No", "1,5"),
        ("b", "u/2", "GROUP#0", "x", "readonly", "9"),
        ("c", "u/ID-7/z", "GROUP#0", "x", "No", "9"),
        ("Area 1", "u/4", "TEAMCHANNEL#0", "Canal de Teams", "No", "9"),
        ("Area 2", "u/5", "GROUP#0", "x", None, "0.25"),
        ("e", "u/6", "GROUP#0", "x", "No", "0"),
        ("f", "u/7", "GROUP#0", "x", "No", None),
        ("g", "u/8", "STS#0", "x", "No", "9"),
    )
    p = params.with_(excluded_ids=("id-7",), channel_prefixes=("area",))
    backlog = inventory.survey_backlog(inv, p)
    assert [(r.site, r.storage_gb) for r in backlog.collect()] == [("a", 1.5), ("Area 2", 0.25)]
    assert collect(inventory.backlog_totals(backlog)) == [(2, 1.8)]  # 1.75 to one decimal, half to even


def test_wildcards_in_lists_are_literal(frame, params):
    rows = site(frame, dict(site="a*b"), dict(site="axb"))
    assert [r.is_legacy for r in inventory.is_legacy(rows, prefixes=["a*"]).collect()] == [True, False]


def test_subsites(frame):
    sites = inventory.site_columns(inventory.site_class(inventory.site_type(site(frame, dict(site="P")))))
    subs = frame(
        "site string, site_url string, parent_url string, template string, last_activity_ts timestamp_ntz",
        ("s", "https://t/s/x", "https://t/s", "STS#0", None),
    )
    every = inventory.add_subsites(sites, subs)
    assert collect(every, "site", "site_type", "storage_gb") == [
        ("P", "Team Site (clásico)", 2.0), ("s", "Subsitio de P", None)
    ]
    assert collect(inventory.inventory_totals(every)) == [(1, 1, 2.0)]


def test_refresh_reasons(frame):
    as_of = datetime(2021, 6, 30)
    sites = frame(
        "site_url string, last_activity_ts timestamp_ntz",
        ("never", as_of), ("failed", as_of), ("newer", datetime(2021, 6, 2)),
        ("recent", datetime(2021, 6, 23)), ("old", datetime(2021, 6, 22)), ("quiet", None),
    )
    surveys = frame(
        "site_url string, surveyed_ts timestamp_ntz, status string",
        ("failed", as_of, "ErrorConexion"), ("newer", datetime(2021, 6, 1), "OK"),
        ("recent", datetime(2021, 6, 24), "OK"), ("old", datetime(2021, 6, 24), "OK"),
        ("old", datetime(2020, 6, 24), "OK"), ("quiet", datetime(2019, 1, 1), "OK"),
    )
    assert collect(refresh.refresh_reason(sites, surveys, as_of), "site_url", "reason") == [
        ("failed", "never"), ("never", "never"), ("newer", "newer"), ("old", "current"),
        ("quiet", "current"), ("recent", "recent"),
    ]
    forced = refresh.refresh_reason(sites, surveys, as_of, 999)
    assert {r.reason for r in forced.collect()} == {"never", "forced"}
    assert collect(refresh.pending(sites, surveys), "site_url") == [("failed",), ("never",)]


def test_latest_snapshot(frame):
    rows = frame(
        "site_url string, path string, survey_no int, size_bytes bigint, note string",
        ("a", "p", 1, 10, "old"), ("a", "p", 2, 5, "x"), ("a", "p", 2, 5, None), ("a", "q", 1, 1, None),
        ("b", "p", 1, 7, None),
    )
    latest = refresh.latest_snapshot(rows)
    assert collect(latest, "site_url", "path", "size_bytes", "note") == [
        ("a", "p", 5, "x"), ("a", "q", 1, None), ("b", "p", 7, None)
    ]
    assert collect(refresh.latest_snapshot(latest)) == collect(latest)
    kept = refresh.latest_snapshot(rows, drop_missing=True)
    assert collect(kept, "site_url", "path") == [("a", "p"), ("b", "p")]
    assert kept.columns == rows.columns
