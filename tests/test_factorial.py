import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import readings
from roomtide.operators import design as designs
from roomtide.operators import effects, factorial
from roomtide.plans import experiments
from roomtide.plans.features import filled_bins
from roomtide.schemas import INFERENCES

HUBS4 = ["RS1", "RS2", "RS4", "RS5"]
# Fixed value: the half fraction for four hubs.
HALF4 = [
    (-1, -1, -1, -1), (-1, -1, 1, 1), (-1, 1, -1, 1), (-1, 1, 1, -1),
    (1, -1, -1, 1), (1, -1, 1, -1), (1, 1, -1, -1), (1, 1, 1, 1),
]


def hub_frame(spark, hubs, home="H1"):
    return spark.createDataFrame([(home, h) for h in hubs], "home STRING, hub STRING")


@pytest.mark.parametrize("count", [4, 5])
def test_full_design(spark, count):
    hubs = [f"RS{i}" for i in range(1, count + 1)]
    runs = designs.design(hub_frame(spark, hubs)).orderBy("run").collect()
    expected = list(itertools.product((-1, 1), repeat=count))
    assert [tuple(r.signs) for r in runs] == expected
    assert [r.run for r in runs] == list(range(1, 2**count + 1))


def test_half_design(spark):
    runs = designs.design(hub_frame(spark, HUBS4), "half").orderBy("run").collect()
    assert [tuple(r.signs) for r in runs] == HALF4
    five = designs.design(hub_frame(spark, [*HUBS4, "RS6"]), "half").collect()
    assert len(five) == 16 and all(np.prod(r.signs) == 1 for r in five)


def test_a_quarter_fraction_of_twenty_hubs(spark):
    hubs = hub_frame(spark, [f"RS{i:02d}" for i in range(1, 21)])
    generators = [range(1, 19), (1, 3, 5, 7)]
    runs = designs.design(hubs, generators=generators)
    ok = " AND ".join(f"signs[{18 + k}] = " + " * ".join(f"signs[{j - 1}]" for j in g) for k, g in enumerate(generators))
    row = runs.agg(
        F.count("*").alias("n"), F.countDistinct("run").alias("runs"), F.min("run").alias("low"), F.max("run").alias("high"),
        F.count_if(F.expr(ok)).alias("ok"), F.countDistinct("signs").alias("signs"),
        *[F.sum(F.col("signs")[j]).alias(f"s{j}") for j in range(20)]).first()
    n = 2 ** 18
    assert (row.n, row.runs, row.low, row.high, row.ok, row.signs) == (n, n, 1, n, n, n)
    assert [row[f"s{j}"] for j in range(20)] == [0] * 20


def test_half_fraction_is_that_of_one_generator(spark):
    hubs = hub_frame(spark, HUBS4)
    half = {(r.run, tuple(r.signs)) for r in designs.design(hubs, "half").collect()}
    assert half == {(r.run, tuple(r.signs)) for r in designs.design(hubs, generators=[(1, 2, 3)]).collect()}


def test_designs_beyond_their_numbers_are_refused(spark):
    with pytest.raises(Exception, match="free hubs"):
        designs.design(hub_frame(spark, [f"RS{i}" for i in range(40)])).collect()
    with pytest.raises(Exception, match="free hubs"):
        designs.design(hub_frame(spark, HUBS4), generators=[(1, 4)]).collect()


def test_channels_follow_signs(spark):
    hubs = hub_frame(spark, HUBS4)
    runs = designs.long_design(designs.design(hubs, "half"), hubs)
    got = {(r.run, r.hub): r.channel
           for r in designs.assign_channels(runs, "img_None").collect()}
    for run, signs in enumerate(HALF4, 1):
        for hub, sign in zip(HUBS4, signs):
            assert got[(run, hub)] == ("img" if sign == 1 else "None")


@pytest.mark.parametrize("comparison", ["img_audio", "audio_None"])
def test_run_series_equals_picking_hub_by_hub(spark, comparison):
    """Hubs cover different, partly disjoint times."""
    rng = np.random.default_rng(5)
    cover = {"RS1": (0, 20), "RS2": (10, 30), "RS3": (60, 70)}
    rows = [
        ("H1", hub, 5 * b, int(rng.integers(0, 2)),
         {"audio": float(rng.random()), "img": float(rng.random()), "temp": float(rng.random())})
        for hub, (lo, hi) in cover.items() for b in range(lo, hi)
    ]
    source = readings(spark, rows)
    _, _, series = experiments.factorial_series(source, comparison, 3)
    got = {(r.run, r.ts): (r.audio, r.img, r.temp, r.occupied, r.pos) for r in series.collect()}

    bins = {}
    for r in filled_bins(source).collect():
        bins.setdefault(r.hub, {})[r.ts] = r
    high, low = comparison.split("_")
    signs = [(0, 0, 0), *itertools.product((-1, 1), repeat=3)]
    expected = {}
    for run, spec in enumerate(signs):
        parts = {}
        for hub, sign in zip(cover, spec):
            channel = {1: high, -1: low, 0: "all"}[sign]
            for ts, r in bins[hub].items():
                entry = parts.setdefault(ts, [])
                if channel != "None":
                    entry.append((r.audio if channel in ("audio", "all") else 0.0,
                                  r.img if channel in ("img", "all") else 0.0, r.temp, r.occupied))
                if hub == "RS1":
                    entry.append((0.0, 0.0, r.temp, r.occupied))
        times = sorted(ts for ts, entry in parts.items() if entry)
        for pos, ts in enumerate(times):
            expected[(run, ts)] = (*np.max(parts[ts], axis=0), pos)
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        assert got[key] == pytest.approx(values)


def inference_frame(spark, rows):
    day = dt.date(2024, 1, 1)
    data = [("H1", hub, day + dt.timedelta(days=d), f"00:00:{s:02d}", a, i, y)
            for hub, d, s, a, i, y in rows]
    return spark.createDataFrame(data, INFERENCES)


def brute_force_daily(rows, hubs, comparison):
    """Outer join, sentinel filter and any-positive prediction, run by run."""
    high, low = comparison.split("_")
    out = {}
    for run, spec in enumerate(itertools.product((-1, 1), repeat=len(hubs)), 1):
        channel = {h: (high if s == 1 else low) for h, s in zip(hubs, spec)}
        silent = all(c == "None" for c in channel.values())
        joined = {}
        for hub, d, s, a, i, y in rows:
            c = channel[hub]
            if silent and hub == hubs[0]:
                joined[(d, s, y)] = [1]
            elif c != "None":
                joined.setdefault((d, s, y), []).append(a if c == "audio" else i)
        for (d, _, y), values in joined.items():
            if -1 not in values:
                counts = out.setdefault((run, d), [0, 0, 0, 0])
                counts[2 * y + int(sum(values) > 0)] += 1
    return out


@pytest.mark.parametrize("comparison", ["img_audio", "audio_None", "img_None"])
def test_model_free_study(spark, comparison):
    rng = np.random.default_rng(11)
    hubs = ["RS1", "RS2", "RS3"]
    rows = [
        (hub, d, s, int(rng.integers(-1, 2)), int(rng.integers(-1, 2)),
         int(rng.integers(0, 2)) if d else 1)
        for hub in hubs for d in range(3) for s in range(40) if rng.random() < 0.8
    ]
    study = experiments.model_free_study(inference_frame(spark, rows), comparison)
    daily = study.daily.toPandas()
    expected = brute_force_daily(rows, hubs, comparison)
    day0 = dt.date(2024, 1, 1)
    got = {(r.run, (r.day - day0).days): [r.tn, r.fp, r.fn, r.tp] for r in daily.itertuples()}
    every = {(run, d): [0, 0, 0, 0] for run in range(1, 9) for d in range(3)}
    assert got == {**every, **expected}

    stats = {r["run"]: r for r in study.statistics.collect()}
    for run, group in daily.groupby("run"):
        for m in factorial.DAILY_METRICS:
            assert stats[run][m] == pytest.approx(group[m].mean())
            assert stats[run][f"var {m}"] == pytest.approx(group[m].var(ddof=0), abs=1e-15)
    errors = study.errors().first()
    for m in factorial.DAILY_METRICS:
        mean_variance = np.mean([stats[r][f"var {m}"] for r in stats])
        assert errors[m] == pytest.approx(np.sqrt(mean_variance * 3 / 8) / 10)
    assert study.report(hubs).count() == 9


def test_a_day_without_complete_rows_counts_as_zero(spark):
    table = inference_frame(spark, [("RS1", 0, 0, 1, 1, 1), ("RS1", 1, 0, -1, 1, 1)])
    daily = experiments.model_free_study(table, "img_audio").daily.collect()
    got = {(r["run"], r["day"].day): (r["tp"], r["Accuracy"], r["F1-Score"]) for r in daily}
    assert len(daily) == 4
    assert sorted(got.values()) == [(0, 0.0, 0.0), (1, 1.0, 1.0), (1, 1.0, 1.0), (1, 1.0, 1.0)]


def test_days_can_be_restricted(spark):
    rows = [("RS1", d, s, 1, 0, 1) for d in range(4) for s in range(3)]
    table = inference_frame(spark, rows)
    days = table.select("home", "day").distinct().where("day <= '2024-01-02'")
    study = experiments.model_free_study(table, "img_audio", days=days)
    assert study.daily.select("day").distinct().count() == 2


def test_sentinel_filter_passes_missing_hubs(spark):
    rows = [("RS1", 0, 0, 1, 0, 1), ("RS2", 0, 0, -1, 0, 1), ("RS1", 0, 1, 0, 0, 1)]
    joined = factorial.outer_join_hubs(inference_frame(spark, rows), "audio", ["RS1", "RS2"])
    assert joined.count() == 2
    kept = factorial.drop_sentinels(joined, ["audio_1", "audio_2"]).collect()
    assert [(r.audio_1, r.audio_2) for r in kept] == [(0, None)]


def test_look_ahead_holds_without_chaining(spark):
    marks = {3, 9}
    rows = [("H1", "RS1", dt.date(2024, 1, 1), t, int(t in marks)) for t in range(24)]
    df = spark.createDataFrame(rows, "home STRING, hub STRING, day DATE, sample_no INT, audio INT")
    got = factorial.look_ahead(df, ["audio"], samples_per_day=24, min_hours=1, max_hours=3)
    values = [r.audio for r in got.orderBy("sample_no").collect()]
    expected = [0] * 24
    for t in marks:
        hold = int(np.round((3 - 1) / 2 * np.cos(t * 2 * np.pi / 24) + 1 + 1))
        for k in range(t, min(24, t + hold + 1)):
            expected[k] = 1
    assert values == expected


def effect_inputs(spark):
    hubs = hub_frame(spark, HUBS4)
    runs = factorial.with_baseline(designs.design(hubs, "half"))
    values = {run: float(v) for run, v in enumerate([7, 3, 1, 4, 1, 5, 9, 2, 6])}
    table = spark.createDataFrame(
        [("H1", run, v, 2 * v) for run, v in values.items()],
        "home STRING, run INT, Accuracy DOUBLE, F1 DOUBLE",
    )
    return hubs, runs, table, values


@pytest.mark.parametrize("count_baseline", [True, False])
def test_effects(spark, count_baseline):
    hubs, runs, table, values = effect_inputs(spark)
    half = (len(HALF4) + count_baseline) / 2
    factors = effects.factors(runs, hubs).unionByName(effects.factors(runs, hubs, 2))
    shuffled = table.orderBy(F.rand(3))
    got = {r.factor: (r.Accuracy, r.F1) for r in effects.effects(
        factors, shuffled, ["Accuracy", "F1"], count_baseline).collect()}
    columns = dict(zip(HUBS4, np.array(HALF4).T))
    observed = np.array([values[r] for r in range(1, 9)])
    expected = {h: (s @ observed) / half for h, s in columns.items()}
    for a, b in itertools.combinations(HUBS4, 2):
        expected[f"{a}x{b}"] = (columns[a] * columns[b]) @ observed / half
    assert got.keys() == expected.keys()
    for name, value in expected.items():
        assert got[name] == (pytest.approx(value), pytest.approx(2 * value))


def test_effects_table(spark):
    hubs, runs, table, values = effect_inputs(spark)
    rows = {r.factor: r.Accuracy for r in
            effects.effects_table(runs, hubs, table, ["Accuracy", "F1"]).collect()}
    assert rows["BL"] == 7.0
    assert rows["avg"] == pytest.approx(np.mean([values[r] for r in range(1, 9)]))
    assert len(rows) == 2 + 4 + 6


def test_three_hub_interactions(spark):
    hubs, runs, _, _ = effect_inputs(spark)
    rows = effects.factors(runs.where("run > 0"), hubs, 3).collect()
    got = {(r.run, r.factor): r.sign for r in rows}
    for run, signs in enumerate(HALF4, 1):
        for combo in itertools.combinations(range(4), 3):
            name = "x".join(HUBS4[i] for i in combo)
            assert got[(run, name)] == np.prod([signs[i] for i in combo])
    assert len(got) == 8 * 4


def test_effects_of_stored_results_equal_direct_ones(spark):
    hubs, runs, table, _ = effect_inputs(spark)
    signs = designs.hub_columns(designs.long_design(runs, hubs), [*HUBS4, "RS9"])
    stored = signs.join(table, ["home", "run"])
    names = ["Accuracy", "F1"]
    direct = {tuple(r) for r in effects.effects_table(runs, hubs, table, names).collect()}
    assert {tuple(r) for r in effects.effects_of_results(stored).collect()} == direct


def test_result_columns_are_told_apart(spark):
    df = spark.createDataFrame([(1, 1, 0.5, 3)], "RS1 INT, BS2 INT, Accuracy DOUBLE, other INT")
    assert effects.split_columns(df) == (["RS1", "BS2"], ["Accuracy"])


def test_a_grid_of_cells_equals_its_cells_one_by_one(spark):
    """Environment on and off times three comparisons in one call; runs share lags per hub set."""
    rng = np.random.default_rng(11)
    rows = []
    for hub in ("RS1", "RS2"):
        for b in range(5 * 288):
            y = int((b // 40 + (hub == "RS2")) % 3 > 0 and rng.random() > 0.1)
            rows.append(("H1", hub, 5 * b, y, {"audio": float(rng.random()), "img": float(rng.random()),
                                               "light": 0.7 * y + 0.3 * float(rng.random())}))
    source = readings(spark, rows)
    comparisons = ["img_audio", "audio_None", "img_None"]
    grid = experiments.factorial_grid(source, comparisons, (True, False), 2)
    cells = {(r.comparison, r.environment, r.home, r.run): r for r in grid.metrics.collect()}
    assert len(cells) == 3 * 2 * (4 + 1)
    sets = grid.runs.select("active").distinct().count()
    assert sets == 2  # both hubs, and the first alone
    for comparison, environment in (("img_audio", True), ("audio_None", False)):
        alone = experiments.factorial_experiment(source, comparison, 2, environment=environment)
        for r in alone.metrics.collect():
            got = cells[comparison, environment, r.home, r.run]
            assert (r.tn, r.fp, r.fn, r.tp) == (got.tn, got.fp, got.fn, got.tp)
        one = grid.cell(comparison, environment)
        of_grid, of_cell = ({(r.home, r.run, r.term): r.value for r in found.coefficients().collect()} for found in (one, alone))
        assert of_grid == pytest.approx(of_cell, abs=1e-9)
        terms = {r.term: r.value for r in one.coefficients().where("run = 1").collect()}
        assert (terms["light"] == 0.0) == (not environment)
    effects_of = grid.effects()
    assert effects_of.select("comparison", "environment").distinct().count() == 6
    assert effects_of.where("comparison = 'img_None' AND NOT environment").count() == grid.cell("img_None", False).effects().count()
