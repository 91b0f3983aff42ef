from __future__ import annotations

import datetime as dt
import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tallyworks.plans import ad_features, ads
from tallyworks.sources.workspace import new_folder

START = dt.datetime(2024, 1, 4)


def random_events(seed, n=600, ads_count=9, one_in=3):
    """Events on a coarse time grid, so that equal times and exact one-hour gaps occur; one hot ad."""
    rng = random.Random(seed)
    return [
        (
            i,
            1 if rng.randrange(one_in) == 0 else rng.randrange(2, 2 + ads_count),
            START + dt.timedelta(minutes=20 * rng.randrange(72 * 3)),
            rng.choice(["view", "view", "click"]),
            rng.choice(["android", "ios", "web"]),
        )
        for i in range(n)
    ]


def in_order(rows):
    """Rows per ad by time, a view before a click of the same time."""
    ordered = sorted(rows, key=lambda r: (r[1], r[2], r[3] == "click", r[0]))
    return {ad: list(group) for ad, group in groupby(ordered, key=lambda r: r[1])}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_late_changes_against_row_by_row(make_ads, seed):
    rows = random_events(seed, n=150 * seed)
    changes = after_view = 0
    for events in in_order(rows).values():
        for before, event in zip(events, events[1:]):
            if event[2] - before[2] > dt.timedelta(hours=1) and event[3] != before[3]:
                changes += 1
                after_view += event[3] == "click"
    assert tuple(ads.late_changes(make_ads(rows)).first()) == (changes, after_view)
    assert changes > 0


def test_gap_of_exactly_an_hour_is_not_late(make_ads):
    rows = [(1, 1, START, "view", "web"), (2, 1, START + dt.timedelta(hours=1), "click", "web")]
    assert tuple(ads.late_changes(make_ads(rows)).first()) == (0, 0)
    rows[1] = (2, 1, START + dt.timedelta(hours=1, microseconds=1), "click", "web")
    assert tuple(ads.late_changes(make_ads(rows)).first()) == (1, 1)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_late_changes_across_clock_changes(spark, make_ads, kind):
    """Spring has no 2:00 and autumn has 1:00 twice in the session's zone; gaps stay what they are."""
    spring, autumn = dt.datetime(2024, 3, 10, 0, 30), dt.datetime(2024, 11, 3, 4, 30)
    rows = [
        (i, 1 + (start == autumn), start + dt.timedelta(minutes=step), "click" if i % 2 else "view", "web")
        for start in (spring, autumn)
        for i, step in enumerate(range(0, 600, 61))
    ]
    frame = make_ads(rows)
    path = new_folder(spark, "clock")
    frame.withColumn("time", F.col("time").cast(kind)).write.parquet(path)
    zone = spark.conf.get("spark.sql.session.timeZone")
    found = {}
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            found[name] = tuple(ads.late_changes(spark.read.parquet(path)).first())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found["UTC"] == found["America/New_York"] == (18, 10)


def test_click_first(make_ads):
    rows = random_events(5)
    pairs = {}
    for event in sorted(rows, key=lambda r: (r[2], r[3] == "click")):
        pairs.setdefault((event[1], event[4]), event[3])
    expected = {ad for (ad, _), first in pairs.items() if first == "click"}
    assert ads.click_first_ads(make_ads(rows)).first()[0] == len(expected)


def test_click_first_ad_without_views(make_ads):
    clicked = [(1, 8, START, "click", "ios")]
    viewed = [(2, 9, START, "view", "ios")]
    assert ads.click_first_ads(make_ads(clicked + viewed)).first()[0] == 1


def test_ctr_without_views_or_clicks(make_ads):
    rows = [(1, 1, START, "click", "web"), (2, 2, START, "view", "web"), (3, 2, START, "view", "ios")]
    frame = make_ads(rows)
    assert [tuple(r) for r in ads.ctr_by(frame, "ad_id").collect()] == [(2, 2, 0, 0.0)]
    features = {r.ad_id: (r.day_count, r.ctr) for r in ad_features.ad_features(frame).collect()}
    assert features == {1: (0, None), 2: (1, 0.0)}
    two_tables = {(r.ad_id, r.days_count, r.ctr) for r in ad_features.event_features_two_tables(frame).collect()}
    assert two_tables == {(1, None, None), (2, 1, 0.0)}
    assert ad_features.event_features(frame).count() == 3


def test_event_grain_without_event_ids(make_ads):
    rows = random_events(7)
    frame = make_ads(rows)
    with_ids = ad_features.event_features(frame).groupBy("ad_id").count()
    without = ad_features.event_features(frame.drop("event_id")).groupBy("ad_id").count()
    assert sorted(map(tuple, with_ids.collect())) == sorted(map(tuple, without.collect()))


def test_orphans(make_ads):
    rows = [(i, 1, START + dt.timedelta(minutes=i), "click", "web" if i % 2 else "ios") for i in range(150)]
    rows += [(200, 2, START, "view", "android"), (201, 2, START, "click", "android")]
    frame = make_ads(rows)
    assert ads.clicked_never_viewed(frame).first()[0] == 1
    assert tuple(ads.orphan_platforms(frame).first()) == (0, 75, 75)
    assert tuple(ads.orphan_platforms(frame, first=100).first()) == (0, 50, 50)
    assert tuple(ads.orphan_platforms_all(frame).first()) == (0, 75, 75)


def test_spike_day_edges(make_ads):
    day = dt.date(2024, 1, 5)
    morning = dt.datetime(2024, 1, 5, 9)
    rows = [
        (1, 1, morning, "view", "web"),  # first seen and largest on the day
        (2, 2, START, "view", "web"),  # seen before, equally large on the day
        (3, 2, morning, "view", "web"),
        (4, 3, START, "view", "web"),  # larger before
        (5, 3, START, "view", "web"),
        (6, 3, morning, "view", "web"),
        (7, 4, START, "view", "web"),  # not seen on the day
    ]
    frame = make_ads(rows)
    row = ads.spike_diagnosis(frame, day).first()
    assert (row.ads, row.perc_peak_on_day, row.perc_first_on_day, row.perc_first_and_peak) == pytest.approx(
        (3, 200 / 3, 100 / 3, 100 / 3)
    )
    peaks = {r.ad_id: (r.day_index, r.peak_on_day, r.first_on_day) for r in ads.ad_peak_day(frame, day).collect()}
    assert peaks == {1: (1, 1, 1), 2: (2, 1, 0), 3: (2, 0, 0)}
    assert [r.ad_id for r in ads.spike_ads_ranked(frame, day).collect()] == [3, 2, 1]
    assert {r.ad_id for r in ads.top_spike_ads_daily(frame, day, 2).collect()} == {3, 2}


def test_anti_join_survives_null_ids(spark):
    clients = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, dt.date(2021, 1, 1))], "client_union_id long, create_date date")
    active = spark.createDataFrame([(1,), (None,)], "client_union_id long")
    assert [r.client_union_id for r in ads.clients_without_ads(clients, active).collect()] == [2]
    row = ads.never_active_share(clients, active).first()
    assert (row.total, row.never, row.part, row.oldest, row.earliest_client) == (
        2, 1, 50.0, dt.date(2021, 1, 1), dt.date(2020, 1, 1),
    )


def test_first_gap_uses_calendar_days(spark, make_ads):
    frame = make_ads([(1, 1, dt.datetime(2024, 1, 6, 0, 30), "view", "web"), (2, 1, dt.datetime(2024, 3, 1), "view", "web")])
    clients = spark.createDataFrame([(1, dt.date(2024, 1, 5)), (3, dt.date(2024, 1, 5))], "client_union_id long, create_date date")
    assert tuple(ads.first_ad_gap(clients, frame).first()) == (1, 1.0, 1)
    assert {tuple(r) for r in ads.client_gap_rows(clients, frame).collect()} == {
        (dt.date(2024, 1, 5), 1, 1), (dt.date(2024, 1, 5), 56, 1),
    }


def test_platform_sets_count_unviewed_ads_in_the_total(make_ads):
    rows = [
        (1, 1, START, "view", "web"), (2, 1, START, "view", "ios"), (3, 2, START, "view", "ios"),
        (4, 2, START, "view", "web"), (5, 3, START, "click", "web"), (6, 4, START, "view", "web"),
    ]
    found = {r.platforms: (r.ads, r.sum_ads, r.perc_ads) for r in ads.platform_sets(make_ads(rows)).collect()}
    assert found == {"ios,web": (2, 4, 50.0), "web": (1, 4, 25.0)}
