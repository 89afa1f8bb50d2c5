import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import START, random_label_readings, readings, rolling_lags
from roomtide.operators import timeseries as ts_ops
from roomtide.plans.features import filled_bins, prepare
from roomtide.schemas import LAGS


def table(df, keys, *columns):
    return {tuple(r[k] for k in keys): tuple(r[c] for c in columns) for r in df.collect()}


def minute(m):
    return START + dt.timedelta(minutes=m)


def test_bins_are_left_closed_means(spark):
    df = readings(spark, [
        ("H1", "RS1", 0, 0, {"audio": 0.2}),
        ("H1", "RS1", 4, 1, {"audio": 0.4}),
        ("H1", "RS1", 5, 1, {"audio": 1.0}),
    ])
    got = table(ts_ops.resample(df), ["ts"], "audio", "occupied")
    assert got[(minute(0),)] == (pytest.approx(0.3), 0.5)
    assert got[(minute(5),)] == (1.0, 1.0)


def test_gaps_become_empty_bins_across_midnight(spark):
    df = readings(spark, [
        ("H1", "RS1", 1420, 1, {"audio": 0.2}),
        ("H1", "RS1", 1460, 1, {"audio": 0.4}),
    ])
    bins = ts_ops.hub_bins(df).orderBy("ts").collect()
    assert [b.ts for b in bins] == [minute(m) for m in range(1420, 1461, 5)]
    assert [b.pos for b in bins] == list(range(9))
    assert [b.n_readings for b in bins] == [1, *[0] * 7, 1]
    assert bins[3].audio is None


def test_half_occupied_bin_counts_as_occupied(spark):
    df = readings(spark, [
        ("H1", "RS1", 0, 0, {}), ("H1", "RS1", 1, 1, {}),
        ("H1", "RS1", 5, 0, {}), ("H1", "RS1", 6, 0, {}), ("H1", "RS1", 7, 1, {}),
        ("H1", "RS1", 10, None, {}),
    ])
    got = table(ts_ops.label_bins(ts_ops.hub_bins(df)), ["ts"], "occupied")
    assert got == {(minute(0),): (1,), (minute(5),): (0,), (minute(10),): (0,)}


@pytest.mark.parametrize(
    "how, expected",
    [("zeros", [0, 0.5, 0, 0, 0.7]), ("ones", [1, 0.5, 1, 1, 0.7]),
     ("ffill", [0, 0.5, 0.5, 0.5, 0.7])],
)
def test_fill(spark, how, expected):
    df = readings(spark, [
        ("H1", "RS1", 1425, 1, {}), ("H1", "RS1", 1430, 1, {"img": 0.5}),
        ("H1", "RS1", 1445, 1, {"img": 0.7}),
    ])
    bins = filled_bins(df, 5, how).orderBy("ts").collect()
    assert [b.img for b in bins] == expected


def test_unknown_fill_is_refused(spark):
    with pytest.raises(ValueError):
        ts_ops.fill(ts_ops.hub_bins(readings(spark, [("H1", "RS1", 0, 1, {})])), "mean")


def test_fusion_is_at_least_every_hub(spark):
    rng = np.random.default_rng(1)
    df = readings(spark, [
        ("H1", f"RS{h}", int(m), int(rng.integers(0, 2)), {"audio": float(rng.random())})
        for h in (1, 2, 3) for m in rng.integers(0, 600, 40)
    ])
    bins = filled_bins(df)
    fused = table(ts_ops.fuse_hubs(bins), ["ts"], "audio", "occupied")
    for row in bins.collect():
        audio, occupied = fused[(row.ts,)]
        assert audio >= row.audio and occupied >= row.occupied


def test_positions_skip_times_no_hub_covers(spark):
    """Two hubs whose recordings neither overlap nor touch, and one that touches."""
    df = readings(spark, [
        ("H1", "RS1", 0, 1, {}), ("H1", "RS1", 20, 1, {}),
        ("H1", "RS2", 25, 1, {}), ("H1", "RS2", 40, 1, {}),
        ("H1", "RS3", 100, 1, {}), ("H1", "RS3", 115, 1, {}),
        ("H1", "RS4", 5, 1, {}), ("H1", "RS4", 10, 1, {}),
    ])
    fused = ts_ops.fuse_hubs(ts_ops.hub_bins(df)).orderBy("ts").collect()
    assert [r.pos for r in fused] == list(range(13))
    assert [r.ts for r in fused] == [minute(m) for m in (*range(0, 41, 5), 100, 105, 110, 115)]


@pytest.mark.parametrize("chunk_rows", [96, 100, 4096])
def test_rolling_lags_equal_brute_force(spark, chunk_rows):
    df, labels = random_label_readings(spark, 450)
    bins = filled_bins(df)
    rows = ts_ops.fused_with_lags(bins, chunk_rows=chunk_rows).orderBy("ts").collect()
    got = np.array([[np.nan if r[c] is None else r[c] for c in LAGS] for r in rows])
    np.testing.assert_array_equal(got, rolling_lags(labels))


def test_lags_go_by_row_across_a_hole_in_the_recording(spark):
    first, a = random_label_readings(spark, 130, 5)
    second, b = random_label_readings(spark, 140, 6, hub="RS2", start_bin=400)
    rows = ts_ops.fused_with_lags(filled_bins(first.union(second)), chunk_rows=96)
    got = np.array([[np.nan if r[c] is None else r[c] for c in LAGS]
                    for r in rows.orderBy("ts").collect()])
    np.testing.assert_array_equal(got, rolling_lags(np.concatenate([a, b])))


def test_six_of_twelve_rounds_to_vacant(spark):
    df = readings(spark, [("H1", "RS1", 5 * i, int(i % 2 == 0), {}) for i in range(13)])
    rows = ts_ops.fused_with_lags(filled_bins(df)).orderBy("ts").collect()
    assert rows[12].lag1_occupied == 0.0 and rows[11].lag1_occupied is None


def test_static_lags(spark):
    df, labels = random_label_readings(spark, 120)
    rows = ts_ops.fused_with_lags(filled_bins(df), rolling=False, chunk_rows=96)
    for t, r in enumerate(rows.orderBy("ts").collect()):
        for i in range(1, 9):
            expected = labels[t - 12 * i] if t >= 12 * i else None
            assert r[f"lag{i}_occupied"] == expected


def test_calendar(spark):
    df = readings(spark, [("H1", "RS1", m, 1, {}) for m in (0, 24 * 60 - 5, 24 * 60 + 6 * 60)])
    rows = table(prepare(df).features, ["ts"], "weekend", "hr_sin", "hr_cos", "tod_min")
    assert rows[(minute(0),)] == (0, pytest.approx(0.5), pytest.approx(1.0), 0)
    assert rows[(minute(24 * 60 - 5),)][0] == 0
    assert rows[(minute(30 * 60),)] == (1, pytest.approx(1.0), pytest.approx(0.5), 360)


def test_one_long_home_spreads_over_chunks(spark):
    df, _ = random_label_readings(spark, 400)
    haloed = ts_ops.with_halo(ts_ops.hub_bins(df), 96, 128)
    sizes = haloed.groupBy("chunk").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 128 + 96 and sizes[1] >= 4
