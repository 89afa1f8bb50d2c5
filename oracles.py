"""DuckDB SQL with the same results as the registered queries, written independently."""

from __future__ import annotations

CHANNELS = ("audio", "img", "temp", "rh", "light", "co2eq")
ENV = CHANNELS[2:]
HOMES = [f"H{i}" for i in range(1, 7)]
HUBS = [f"RS{i}" for i in range(1, 6)]
METRICS = ("Accuracy", "F1", "F1 neg", "tnr", "fpr", "fnr", "tpr", "tn", "fp", "fn", "tp")
LAGS = [f"lag{i}_occupied" for i in range(1, 9)]
# Order of a model's features and of the rows of coefficient reports.
EXOGENOUS = ["audio", "co2eq", "light", "rh", "temp", "img", "weekend", "hr_sin", "hr_cos"]
FEATURES = EXOGENOUS + LAGS
TERM_ORDER = ["C", "Intercept", "audio", "img", "temp", "rh", "light", "co2eq", "weekend", "hr_cos", "hr_sin"] + LAGS
# Example weights, one for each feature and the intercept last.
EXAMPLE_WEIGHTS = {
    "H1": (0.5, 1.5, 0.1, -0.2, 2.0, 0.3, 0.4, 0.2, 1.1, 3.5, -0.6, 0.1, 0.2, -0.1, -0.1, 0.05, 0.3, -2.5),
    "H2": (3.2, 2.5, 0.0, 0.4, 0.0, 2.9, 0.2, 1.2, 0.6, 2.8, 0.0, 0.2, 0.0, 0.1, 0.0, -0.2, 0.0, -2.2),
}


def each(template: str, names=CHANNELS, sep: str = ", ") -> str:
    return sep.join(template.replace("{}", n) for n in names)


def r9(expr: str, name: str, digits: int = 9) -> str:
    return f'round({expr}, {digits}) + 0.0::DOUBLE AS "{name}"'


READINGS = """
readings AS (
  SELECT 'H' || (user_id % 6 + 1) AS home, 'RS' || ((user_id // 6) % 5 + 1) AS hub, ts,
    CASE WHEN event_type = 'click' THEN x END AS audio,
    CASE WHEN event_type = 'view' THEN x END AS img,
    CASE WHEN event_type = 'purchase' THEN x END AS temp,
    CASE WHEN event_type = 'signup' THEN x END AS rh,
    CASE WHEN event_type = 'error' THEN x END AS light,
    0.5::DOUBLE * x AS co2eq,
    (value > 30)::INT::DOUBLE AS occupied
  FROM (SELECT *, least(value / 100::DOUBLE, 1.0::DOUBLE) AS x FROM events)
)"""


def bins(minutes: int) -> str:
    """Gap-filled means per hub and bin, label binarised."""
    step = f"INTERVAL '{minutes} minutes'"
    return f"""{READINGS},
means AS (
  SELECT home, hub, time_bucket({step}, ts) AS ts, {each('avg({}) AS {}')},
    avg(occupied) AS occ, count(*) AS n
  FROM readings GROUP BY 1, 2, 3
),
slots AS (
  SELECT home, hub, unnest(generate_series(a, z, {step})) AS ts
  FROM (SELECT home, hub, min(ts) AS a, max(ts) AS z FROM means GROUP BY 1, 2)
),
bins AS (
  SELECT s.home, s.hub, s.ts, {each('m.{}')}, coalesce(m.n, 0) AS n_readings,
    CASE WHEN m.occ >= 0.5 THEN 1 ELSE 0 END AS occupied
  FROM slots s LEFT JOIN means m ON s.home = m.home AND s.hub = m.hub AND s.ts = m.ts
)"""


def fused(minutes: int = 60) -> str:
    return f"""{bins(minutes)},
fused AS (
  SELECT home, ts, {each('max(coalesce({}, 0.0::DOUBLE)) AS {}')}, max(occupied) AS occupied
  FROM bins GROUP BY 1, 2
)"""


def calendar(minutes: int = 60) -> str:
    return f"""{fused(minutes)},
cal AS (
  SELECT *, ts::DATE AS day, (isodow(ts) >= 6)::INT AS weekend,
    (hour(ts) * 60 + minute(ts))::INT AS tod_min,
    0.5::DOUBLE * sin((hour(ts) + minute(ts) / 60::DOUBLE) * (pi() / 12)) + 0.5::DOUBLE AS hr_sin,
    0.5::DOUBLE * cos((hour(ts) + minute(ts) / 60::DOUBLE) * (pi() / 12)) + 0.5::DOUBLE AS hr_cos
  FROM fused
)"""


def rolling_lag(i: int) -> str:
    frame = (f"PARTITION BY home ORDER BY ts ROWS BETWEEN {12 * i + 12} PRECEDING "
             f"AND {12 * i + 1} PRECEDING")
    return (f"CASE WHEN count(*) OVER ({frame}) = 12 "
            f"THEN round_even(avg(occupied) OVER ({frame}), 0) END AS lag{i + 1}_occupied")


def lagged(minutes: int = 60) -> str:
    lags = ", ".join(rolling_lag(i) for i in range(8))
    return f"{calendar(minutes)},\nlagged AS (SELECT *, {lags} FROM cal)"


DAYS = """
days AS (
  SELECT home, day, row_number() OVER (PARTITION BY home ORDER BY day)::INT AS day_no,
    count(*) OVER (PARTITION BY home) AS n_days
  FROM (SELECT DISTINCT home, ts::DATE AS day FROM fused)
)"""
ROLES = f"""{DAYS},
roles AS (
  SELECT home, day, day_no,
    CASE WHEN day_no <= floor(n_days * 0.6::DOUBLE) THEN 'train' ELSE 'test' END AS role
  FROM days
)"""
SWEEP_ROLES = f"""{DAYS},
ratios AS (SELECT unnest([0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]::DOUBLE[]) AS split),
normal AS (
  SELECT home, day, split,
    CASE WHEN day_no <= floor(n_days * split) THEN 'train' ELSE 'test' END AS role
  FROM days, ratios
),
sweep AS (
  SELECT home, day, split, 'normal' AS direction, role FROM normal
  UNION ALL
  SELECT home, day, split, 'reverse', CASE role WHEN 'train' THEN 'test' ELSE 'train' END
  FROM normal
)"""

COUNTS = """count(*) FILTER (WHERE occupied = 0 AND pred = 0) AS tn,
  count(*) FILTER (WHERE occupied = 0 AND pred = 1) AS fp,
  count(*) FILTER (WHERE occupied = 1 AND pred = 0) AS fn,
  count(*) FILTER (WHERE occupied = 1 AND pred = 1) AS tp"""


def ratio(top: str, bottom: str) -> str:
    return f"coalesce(({top})::DOUBLE / nullif({bottom}, 0), 0.0::DOUBLE)"


RATES = {
    "Accuracy": ratio("tp + tn", "tn + fp + fn + tp"),
    "RMSE": f"sqrt({ratio('fp + fn', 'tn + fp + fn + tp')})",
    "F1": ratio("2 * tp", "2 * tp + fp + fn"),
    "F1 neg": ratio("2 * tn", "2 * tn + fp + fn"),
    "tnr": ratio("tn", "tn + fp"),
    "fpr": ratio("fp", "tn + fp"),
    "fnr": ratio("fn", "tp + fn"),
    "tpr": ratio("tp", "tp + fn"),
}
SIG = {"Accuracy": 4, "RMSE": 4, "F1": 4, "F1 neg": 4, "tnr": 3, "fpr": 3, "fnr": 3, "tpr": 3}
RATES_9 = ", ".join(r9(e, n) for n, e in RATES.items()) + ", tn, fp, fn, tp"
RATES_RAW = ", ".join(f'{e} AS "{n}"' for n, e in RATES.items()) + ", tn, fp, fn, tp"


def sig(expr: str, digits: int) -> str:
    power = f"pow(10.0::DOUBLE, {digits - 1} - floor(log10(abs({expr}))))"
    return (f"CASE WHEN ({expr}) = 0 THEN 0.0::DOUBLE "
            f"ELSE round(({expr}) * {power}) / {power} END")


def sig_text(expr: str, digits: int) -> str:
    value = sig(expr, digits)
    text = f"rtrim(({value})::DECIMAL(30, 12)::VARCHAR, '0')"
    return f"CASE WHEN {text} LIKE '%.' THEN {text} || '0' ELSE {text} END"


LOOKUP = f"""{calendar()},{ROLES},
rows_ AS (SELECT c.*, r.role FROM cal c JOIN roles r ON c.home = r.home AND c.day = r.day),
model AS (
  SELECT home, weekend, tod_min, avg(occupied) AS prob_np FROM rows_ WHERE role = 'train'
  GROUP BY 1, 2, 3
)"""
OWN_HOME = f"""{LOOKUP},
own AS (
  SELECT t.home, t.ts, t.occupied, m.prob_np,
    CASE WHEN m.prob_np >= 0.5 THEN 1 ELSE 0 END AS pred
  FROM rows_ t LEFT JOIN model m
    ON t.home = m.home AND t.weekend = m.weekend AND t.tod_min = m.tod_min
  WHERE t.role = 'test'
)"""
MATRIX = f"""{LOOKUP},
homes AS (SELECT DISTINCT home AS train FROM rows_),
matrix AS (
  SELECT train, test, {COUNTS} FROM (
    SELECT h.train, t.home AS test, t.occupied,
      CASE WHEN m.prob_np >= 0.5 THEN 1 ELSE 0 END AS pred
    FROM rows_ t CROSS JOIN homes h LEFT JOIN model m
      ON m.home = h.train AND t.weekend = m.weekend AND t.tod_min = m.tod_min
    WHERE t.role = 'test') GROUP BY 1, 2
),
scored AS (
  SELECT train, test, CASE WHEN train = test THEN 'self' ELSE 'cross' END AS "self/cross",
    'Nonparametric' AS function, {RATES_RAW} FROM matrix
)"""


def pivot(value: str, by: str = "test", names=HOMES) -> str:
    return ", ".join(f"max(CASE WHEN {by} = '{n}' THEN {value} END) AS {n}" for n in names)


OR_AI = "greatest(audio, img)"
OR_AIE = "greatest(audio, img, temp, rh, light, co2eq)"

# --- scoring with literal coefficients ----------------------------------------------------
EXAMPLES = ", ".join(
    "('" + name + "', " + ", ".join(f"{w}::DOUBLE" for w in weights) + ")"
    for name, weights in EXAMPLE_WEIGHTS.items()
)
SCORED = f"""{lagged()},{ROLES},
weights(train, {', '.join('w_' + f for f in FEATURES)}, w0) AS (VALUES {EXAMPLES}),
complete AS (
  SELECT l.*, r.role FROM lagged l JOIN roles r ON l.home = r.home AND l.day = r.day
  WHERE lag8_occupied IS NOT NULL
),
tests AS (
  SELECT *, row_number() OVER (PARTITION BY home ORDER BY ts) - 1 AS series_pos
  FROM complete WHERE role = 'test'
),
scored AS (
  SELECT w.train, t.*, 1 / (1 + exp(-(w0 + {' + '.join(f'w_{f} * {f}' for f in FEATURES)})))
    AS prob_gt
  FROM tests t CROSS JOIN weights w
)"""

# The regression fed with its own predictions: lag j is the mean of 12 earlier ones once they exist.
TRUE_LAG = " + ".join(
    f"CASE WHEN series_pos < {12 * j} THEN w_{lag} * {lag} ELSE 0 END" for j, lag in enumerate(LAGS, 1))
OWN_LAG = " + ".join(
    f"CASE WHEN r.pos + 1 >= {12 * j} THEN s.lag_weights[{j}] * list_avg(r.recent[{12 * j - 11}:{12 * j}]) ELSE 0 END"
    for j in range(1, 9))
ROLLED = f"""{SCORED},
series AS MATERIALIZED (
  SELECT w.train || '|' || home AS series_id, any_value([{', '.join('w_' + f for f in LAGS)}]) AS lag_weights,
    list(w0 + {' + '.join(f'w_{f} * {f}' for f in EXOGENOUS)} + {TRUE_LAG} ORDER BY series_pos) AS bases
  FROM tests t CROSS JOIN weights w GROUP BY 1
),
rolled AS (
  SELECT series_id, 0::BIGINT AS pos, 1 / (1 + exp(-bases[1])) AS prob, [1 / (1 + exp(-bases[1]))] AS recent FROM series
  UNION ALL
  SELECT series_id, pos, prob, list_prepend(prob, recent[1:95]) FROM (
    SELECT r.series_id, r.pos + 1 AS pos, r.recent, 1 / (1 + exp(-(s.bases[r.pos + 2] + {OWN_LAG}))) AS prob
    FROM rolled r JOIN series s ON r.series_id = s.series_id WHERE r.pos + 1 < len(s.bases))
)"""

# All five predictors of the example models, row by row.
FIVE = f"""{ROLLED},
lookup AS (
  SELECT l.home, weekend, tod_min, avg(occupied) AS prob_np
  FROM lagged l JOIN roles r ON l.home = r.home AND l.day = r.day
  WHERE r.role = 'train' GROUP BY 1, 2, 3
),
five AS (
  SELECT s.train || '|' || s.home AS series_id, s.series_pos, s.ts, s.occupied,
    {OR_AI} AS prob_ai, ({OR_AI} > 0.5)::INT AS pred_ai, {OR_AIE} AS prob_aie, ({OR_AIE} > 0.5)::INT AS pred_aie,
    k.prob_np, CASE WHEN k.prob_np >= 0.5 THEN 1 ELSE 0 END AS pred_np, prob_gt, (prob_gt > 0.5)::INT AS pred_gt,
    r.prob AS prob_ar, (r.prob > 0.5)::INT AS pred_ar
  FROM scored s
  JOIN rolled r ON r.series_id = s.train || '|' || s.home AND r.pos = s.series_pos
  LEFT JOIN lookup k ON k.home = s.train AND k.weekend = s.weekend AND k.tod_min = s.tod_min
)"""
FIVE_NAMES = {"OR (ai)": "ai", "OR (aie)": "aie", "Nonparametric": "np", "ground truth AR": "gt", "AR predictions (aie)": "ar"}


def optimality(listed: str = "1") -> str:
    """Training rows with all lags; every fit must be optimal for a listed strength."""
    return f"""WITH {lagged()},{ROLES}
SELECT l.home, count(*) AS n_rows, sum(occupied)::BIGINT AS n_occupied, 1 AS optimal, {listed} AS strength_listed
FROM lagged l JOIN roles r ON l.home = r.home AND l.day = r.day
WHERE r.role = 'train' AND lag8_occupied IS NOT NULL GROUP BY 1"""


# --- relabelling -----------------------------------------------------------------------------
TRUTH = f"""{READINGS},
truth AS (
  SELECT 'H' || (user_id % 6 + 1) AS home, ts,
    max((event_type IN ('click', 'view', 'purchase', 'signup') AND value > 20)::INT) AS occ_max
  FROM events WHERE event_type <> 'error' GROUP BY 1, 2
),
matched AS (
  SELECT r.*, t.occ_max FROM readings r JOIN truth t ON r.home = t.home AND r.ts = t.ts
)"""

# --- factorial -------------------------------------------------------------------------------
HUB_LIST = f"""{READINGS},
hubs AS (
  SELECT home, hub, row_number() OVER (PARTITION BY home ORDER BY hub) AS hub_no,
    count(*) OVER (PARTITION BY home) AS k
  FROM (SELECT DISTINCT home, hub FROM readings)
)"""
DESIGN = """
full_signs AS (
  SELECT home, hub, hub_no, run_no,
    CASE WHEN (run_no // (2 ** (k - hub_no))::BIGINT) % 2 = 1 THEN 1 ELSE -1 END AS sign
  FROM (SELECT *, unnest(generate_series(0, (2 ** k)::BIGINT - 1)) AS run_no FROM hubs)
),
even_runs AS (
  SELECT home, run_no, row_number() OVER (PARTITION BY home ORDER BY run_no) AS run
  FROM (SELECT home, run_no FROM full_signs GROUP BY 1, 2 HAVING product(sign) > 0)
),
signs_full AS (SELECT home, (run_no + 1)::INT AS run, hub, hub_no, sign FROM full_signs),
signs_half AS (
  SELECT s.home, e.run::INT AS run, s.hub, s.hub_no, s.sign
  FROM full_signs s JOIN even_runs e ON s.home = e.home AND s.run_no = e.run_no
)"""


def with_hubs(base: str) -> str:
    """Append hub list and design to CTEs that already hold ``readings``."""
    return base + "," + HUB_LIST[len(READINGS) + 1:] + "," + DESIGN


INFERENCES = f"""{with_hubs(bins(60))},
inf AS (
  SELECT home, hub, ts::DATE AS day, strftime(ts, '%H:%M:%S') AS hr_min_sec,
    CASE WHEN n_readings = 0 THEN -1 ELSE (coalesce(audio, 0) > 0.5)::INT END AS audio,
    CASE WHEN n_readings = 0 THEN -1 ELSE (coalesce(img, 0) > 0.5)::INT END AS img,
    occupied
  FROM bins
)"""


def model_free(high: str, low: str) -> str:
    def value(channel: str) -> str:
        return "NULL::INT" if channel == "None" else f"i.{channel}"

    return f"""{INFERENCES},
chosen AS (
  SELECT s.home, s.run, i.day, i.hr_min_sec, i.occupied, i.hub, s.hub_no,
    CASE s.sign WHEN 1 THEN '{high}' ELSE '{low}' END AS channel,
    CASE s.sign WHEN 1 THEN {value(high)} ELSE {value(low)} END AS v
  FROM signs_full s JOIN inf i ON s.home = i.home AND s.hub = i.hub
),
silent AS (
  SELECT home, run FROM chosen GROUP BY 1, 2 HAVING bool_and(channel = 'None')
),
joined AS (
  SELECT c.home, c.run, day, hr_min_sec, occupied,
    max((s.run IS NOT NULL)::INT) AS is_silent,
    sum(v) AS total, min(v) AS lowest
  FROM chosen c LEFT JOIN silent s ON c.home = s.home AND c.run = s.run
  WHERE v IS NOT NULL OR (s.run IS NOT NULL AND c.hub_no = 1)
  GROUP BY ALL
),
predicted AS (
  SELECT home, run, day, occupied,
    CASE WHEN is_silent = 1 OR total > 0 THEN 1 ELSE 0 END AS pred
  FROM joined WHERE is_silent = 1 OR lowest <> -1
),
listed AS (
  SELECT r.home, r.run, d.day FROM (SELECT DISTINCT home, run FROM signs_full) r
  JOIN (SELECT DISTINCT home, day FROM inf) d ON r.home = d.home
),
daily_counts AS (
  SELECT l.home, l.run, l.day, {COUNTS}
  FROM listed l LEFT JOIN predicted p ON l.home = p.home AND l.run = p.run AND l.day = p.day
  GROUP BY 1, 2, 3
),
daily AS (
  SELECT home, run, day, tn, fp, fn, tp,
    {', '.join(f'{sig(RATES[m.lower()], 4)} AS "{m}"' for m in ('FPR', 'TPR', 'FNR', 'TNR'))},
    {RATES['F1']} AS "F1-Score", {RATES['Accuracy']} AS "Accuracy"
  FROM daily_counts
)"""


DAILY = ("FPR", "TPR", "FNR", "TNR", "F1-Score", "Accuracy")
RUN_STATS = f"""
stats AS (
  SELECT home, run, {', '.join(f'avg("{m}") AS "{m}", var_pop("{m}") AS "var {m}"' for m in DAILY)}
  FROM daily GROUP BY 1, 2
)"""
STANDARD_ERRORS = f"""
errs AS (
  SELECT s.home, {', '.join(
      f'sqrt(avg("var {m}") * (max(d.n)::DOUBLE / count(*))) / 10 AS "{m}"' for m in DAILY)}
  FROM stats s JOIN (SELECT home, count(DISTINCT day) AS n FROM inf GROUP BY 1) d
    ON s.home = d.home GROUP BY 1
)"""


def value_counts(high: str, low: str) -> str:
    """Values of every column a run sees; the run without channels sees ``null``, always 1."""
    return f"""WITH {model_free(high, low)},
visible AS (
  SELECT home, run, day, hr_min_sec, occupied, channel || '_' || substr(hub, 3) AS "column", v
  FROM chosen WHERE v IS NOT NULL
  UNION ALL
  SELECT c.home, c.run, day, hr_min_sec, occupied, 'null', 1
  FROM chosen c JOIN silent s ON c.home = s.home AND c.run = s.run WHERE c.hub_no = 1
),
flagged AS (
  SELECT home, run, "column", v,
    min(v) OVER (PARTITION BY home, run, day, hr_min_sec, occupied) <> -1 AS kept
  FROM visible
),
staged AS (
  SELECT *, 'before' AS stage, TRUE AS counted FROM flagged
  UNION ALL SELECT *, 'after', kept FROM flagged
)
SELECT home, run, "column", stage, count(*) FILTER (WHERE counted AND v = -1) AS n_missing,
  count(*) FILTER (WHERE counted AND v = 0) AS n_0,
  count(*) FILTER (WHERE counted AND v = 1) AS n_1,
  count(*) FILTER (WHERE counted) AS total
FROM staged GROUP BY 1, 2, 3, 4"""


def run_series(high: str, low: str, design: str = "signs_half") -> str:
    """Fused series of every run, built the plain way: pick channels, union, MAX."""
    used = [c for c in (high, low) if c != "None"]

    def pick(channel: str) -> str:
        signs = [s for s, c in ((1, high), (-1, low)) if c == channel]
        return f"CASE WHEN sign IN ({', '.join(map(str, [0, *signs]))}) THEN {channel} END"

    zero_frames = f"""
  UNION ALL
  SELECT b.home, h.run, b.ts, {', '.join('0.0::DOUBLE' if c in used else 'NULL::DOUBLE'
                                        for c in ('audio', 'img'))}, {each('{}', ENV)}, occupied
  FROM filled b JOIN (SELECT DISTINCT home, run FROM {design}) h ON b.home = h.home
  JOIN hubs ON hubs.home = b.home AND hubs.hub = b.hub AND hubs.hub_no = 1"""
    silent = [s for s, c in ((1, high), (-1, low)) if c == "None"]
    keep = f"sign NOT IN ({', '.join(map(str, silent))})" if silent else "TRUE"
    return f"""{with_hubs(bins(60))},
filled AS (SELECT home, hub, ts, {each('coalesce({}, 0.0::DOUBLE) AS {}')}, occupied FROM bins),
signs_all AS (
  SELECT home, run, hub, sign FROM {design}
  UNION ALL SELECT home, 0, hub, 0 FROM hubs
),
parts AS (
  SELECT b.home, s.run, b.ts, {pick('audio')} AS audio, {pick('img')} AS img,
    {each('{}', ENV)}, occupied
  FROM filled b JOIN signs_all s ON b.home = s.home AND b.hub = s.hub WHERE {keep}{zero_frames}
),
series AS (
  SELECT home, run, ts, {each('coalesce(max({}), 0.0::DOUBLE) AS {}')},
    max(occupied) AS occupied
  FROM parts GROUP BY 1, 2, 3
)"""


RUN_RATES = f"""
run_counts AS (
  SELECT home, run, {COUNTS} FROM (SELECT *, ({OR_AI} > 0.5)::INT AS pred FROM series) GROUP BY 1, 2
),
run_metrics AS (SELECT home, run, {RATES_RAW} FROM run_counts),
singles AS (SELECT home, run, hub AS factor, sign FROM signs_all),
pairs AS (
  SELECT a.home, a.run, a.hub || 'x' || b.hub AS factor, a.sign * b.sign AS sign
  FROM signs_all a JOIN signs_all b ON a.home = b.home AND a.run = b.run AND a.hub < b.hub
)"""
RUN_METRICS = f"{run_series('img', 'audio')},{RUN_RATES}"
FULL_RUN_METRICS = f"{run_series('img', 'audio', 'signs_full')},{RUN_RATES}"


# The grid: three comparisons, with and without environment.
GRID = [(high, low, env) for high, low in (("audio", "None"), ("img", "audio"), ("img", "None")) for env in (True, False)]


def cell(high: str, low: str, env: bool, body: str) -> str:
    return f"""SELECT '{high}_{low}' AS comparison, {str(env).upper()} AS environment, * FROM ({body})"""


def grid_features() -> str:
    def one(high: str, low: str, env: bool) -> str:
        kept = each("round({}, 9) AS {}", CHANNELS if env else ("audio", "img"))
        none = "" if env else ", " + each("0.0::DOUBLE AS {}", ENV)
        return cell(high, low, env, f"WITH {run_series(high, low)} SELECT home, run, ts, {kept}{none}, occupied FROM series")

    return " UNION ALL BY NAME ".join(one(*c) for c in GRID)


def grid_effects() -> str:
    def one(high: str, low: str, env: bool) -> str:
        rates = RUN_RATES.replace(OR_AI, OR_AIE) if env else RUN_RATES
        return cell(high, low, env, f"WITH {run_series(high, low)},{rates} {whole_effects()}")

    return " UNION ALL BY NAME ".join(one(*c) for c in GRID)


def grid_lags() -> str:
    """Lags of every set of active hubs that occurs in the grid's half designs."""
    each_run = " UNION ALL ".join(
        f"SELECT home, '{h}{lo}' || run AS run, string_agg(hub_no::VARCHAR, ',' ORDER BY hub_no) AS active FROM signs_half "
        f"WHERE sign NOT IN ({', '.join(str(s) for s, c in ((1, h), (-1, lo)) if c == 'None') or '9'}) OR hub_no = 1 GROUP BY 1, 2"
        for h, lo in (("audio", "None"), ("img", "audio")))
    lags = ", ".join(
        f"CASE WHEN row_number() OVER w > {12 * i} THEN round_even(avg(occupied) OVER (PARTITION BY home, active ORDER BY ts "
        f"ROWS BETWEEN {12 * i} PRECEDING AND {12 * i - 11} PRECEDING), 0) END AS {lag}" for i, lag in enumerate(LAGS, 1))
    return f"""WITH {with_hubs(bins(60))},
all_sets AS (SELECT DISTINCT home, active FROM ({each_run})),
fused_sets AS (
  SELECT a.home, a.active, b.ts, max(b.occupied) AS occupied
  FROM all_sets a JOIN hubs h ON h.home = a.home AND list_contains(string_split(a.active, ','), h.hub_no::VARCHAR)
  JOIN bins b ON b.home = a.home AND b.hub = h.hub GROUP BY 1, 2, 3
)
SELECT home, active, ts, occupied, {lags} FROM fused_sets WINDOW w AS (PARTITION BY home, active ORDER BY ts)"""


def whole_effects() -> str:
    return f"""SELECT home, 'BL' AS factor, {', '.join(r9(f'max("{m}")::DOUBLE', m) for m in METRICS)}
FROM run_metrics WHERE run = 0 GROUP BY 1
UNION ALL
SELECT home, 'avg', {', '.join(f'round(avg("{m}"), 9)' for m in METRICS)}
FROM run_metrics WHERE run <> 0 GROUP BY 1
UNION ALL {effect_query('singles')} UNION ALL {effect_query('pairs')}"""


# Thresholds of the configured hubs, hub numbers 1 to 5, null where a home has none.
CONFIGURED = {"H1": (0.3, 0.5, 0.3, 0.3, 0.3), "H2": (0.3, 0.3, None, 0.3, 0.3), "H3": (0.3, 0.2, 0.4, 0.5, 0.5),
              "H4": (0.3, 0.4, 0.35, 0.3, 0.3), "H5": (0.3, 0.5, 0.6, 0.3, 0.4), "H6": (None, 0.3, 0.3, 0.5, 0.6)}
HUB_THRESHOLDS = ", ".join(
    f"('{home}', '{'BS' if home == 'H6' else 'RS'}{n}', {t}::DOUBLE)"
    for home, hubs in CONFIGURED.items() for n, t in enumerate(hubs, 1) if t is not None)


def effect_columns() -> str:
    return ", ".join(
        r9(f'sum(sign * m."{m}"::DOUBLE) / (count(*) / 2::DOUBLE)', m) for m in METRICS
    )


def effect_query(factors: str, where: str = "TRUE") -> str:
    return (f"SELECT f.home, factor, {effect_columns()} FROM {factors} f JOIN run_metrics m "
            f"ON f.home = m.home AND f.run = m.run WHERE {where} GROUP BY 1, 2")


# --- coefficient reports ---------------------------------------------------------------------
def channel_means(role: str, name: str = "coefs") -> str:
    parts = " UNION ALL ".join(
        f"SELECT home AS train_home, '{c}' AS term, avg({c}) AS value FROM rows_ "
        f"WHERE role = '{role}' GROUP BY 1" for c in CHANNELS
    )
    return f"{name} AS ({parts})"


def summary(source: str, name: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT *, med - min AS lbMed, max - med AS ubMed, mean - min AS lbMean, max - mean AS ubMean,
    mean - 1.96::DOUBLE * stdev / sqrt(6::DOUBLE) AS errors
  FROM (
    SELECT term, avg(value) AS mean, median(value) AS med, min(value) AS min, max(value) AS max,
      stddev_samp(value) AS stdev FROM {source} WHERE {where} GROUP BY 1)
)"""


SUMMARY = ("mean", "med", "min", "max", "lbMed", "ubMed", "lbMean", "ubMean", "stdev", "errors")
JOINED = ("mean", "errors", "med", "min", "max", "lbMean", "ubMean", "lbMed", "ubMed")
COMPAT = f"""{LOOKUP},{channel_means('train')},
kept AS (SELECT * FROM coefs WHERE train_home <> 'H4'),
middles AS (SELECT term, avg(value) AS mean, min(value) AS min, max(value) AS max FROM kept GROUP BY 1),
meds AS (
  SELECT term, median(value) AS med
  FROM (SELECT term, value FROM kept UNION ALL SELECT term, mean FROM middles) GROUP BY 1
),
derived AS (
  SELECT *, med - min AS lbMed, max - med AS ubMed, mean - min AS lbMean, max - mean AS ubMean
  FROM middles JOIN meds USING (term)
),
cells AS (
  SELECT term, value FROM kept
  UNION ALL SELECT term, unnest([mean, med, min, max, lbMed, ubMed, lbMean, ubMean]) FROM derived
),
spread AS (SELECT term, stddev_samp(value) AS stdev FROM cells GROUP BY 1),
final AS (
  SELECT *, mean - 1.96::DOUBLE * stdev / sqrt(6::DOUBLE) AS errors
  FROM derived JOIN spread USING (term)
)"""


def gapfill(how: str) -> str:
    if how == "ffill":
        values = each(
            "round(coalesce(last_value({} IGNORE NULLS) OVER w, 0.0::DOUBLE), 9) AS {}"
        )
        window = ("WINDOW w AS (PARTITION BY home, hub ORDER BY ts "
                  "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    else:
        constant = {"zeros": "0.0", "ones": "1.0"}[how]
        values, window = each(f"round(coalesce({{}}, {constant}::DOUBLE), 9) AS {{}}"), ""
    return f"WITH {bins(60)} SELECT home, hub, ts, {values}, occupied FROM bins {window}"


def static_lag(i: int) -> str:
    return (f"lag(occupied, {12 * i}) OVER (PARTITION BY home ORDER BY ts)::DOUBLE "
            f"AS lag{i}_occupied")


HUB_SIGNS = ", ".join(f"max(CASE WHEN hub = '{h}' THEN sign END) AS {h}" for h in HUBS)
AUDIO_COLUMNS = [f"audio_{i}" for i in range(1, 6)]
LOOK_AHEAD = ", ".join(
    f"""CASE WHEN max(CASE WHEN {c} = 1 THEN sample_no + hold END) OVER (
    PARTITION BY home, hub, day ORDER BY sample_no ROWS UNBOUNDED PRECEDING) >= sample_no
    THEN 1 ELSE {c} END AS {c}""" for c in ("audio", "img")
)
INTERLEAVED_TERMS = ", ".join(f"'{t}'" for t in TERM_ORDER)

ORACLES: dict[str, str] = {
    "resample_5min": f"""WITH {READINGS}
SELECT home, hub, time_bucket(INTERVAL '5 minutes', ts) AS ts,
  {each('round(avg({}), 9) AS {}', (*CHANNELS, 'occupied'))} FROM readings GROUP BY 1, 2, 3""",
    "channel_subset": f"""WITH {READINGS}
SELECT home, hub, time_bucket(INTERVAL '60 minutes', ts) AS ts,
  round(avg(audio), 9) AS audio, round(avg(occupied), 9) AS occupied
FROM readings GROUP BY 1, 2, 3""",
    "gapfill_zeros": gapfill("zeros"),
    "gapfill_ones": gapfill("ones"),
    "gapfill_ffill": gapfill("ffill"),
    "hub_fusion": f"""WITH {fused(5)}
SELECT home, ts, {each('round({}, 9) AS {}')}, occupied FROM fused""",
    "calendar_features": f"""WITH {calendar()}
SELECT home, ts, day, weekend, tod_min, {each('round({}, 9) AS {}', ('hr_sin', 'hr_cos'))}
FROM cal""",
    "static_lags": f"""WITH {fused()}
SELECT home, ts, occupied, {', '.join(static_lag(i) for i in range(1, 9))} FROM fused""",
    "rolling_lags": f"""WITH {fused()}
SELECT home, ts, occupied, {', '.join(rolling_lag(i) for i in range(8))} FROM fused""",
    "model_features": f"""WITH {lagged()},{ROLES}
SELECT l.home, l.ts, r.role,
  {each('round({}, 9) AS {}', (*CHANNELS, 'hr_sin', 'hr_cos'))}, weekend,
  {', '.join(LAGS)}, occupied
FROM lagged l JOIN roles r ON l.home = r.home AND l.day = r.day WHERE lag8_occupied IS NOT NULL""",
    "environment_dropped": f"""WITH {calendar()}
SELECT home, ts, round(audio, 9) AS audio, round(img, 9) AS img, occupied, weekend FROM cal""",
    "day_split": f"WITH {fused()},{ROLES} SELECT home, day, day_no, role FROM roles",
    "split_sweep_days": f"""WITH {fused()},{SWEEP_ROLES}
SELECT home, day, split, direction, role FROM sweep""",
    "train_day_rows": f"""WITH {fused()},{ROLES}
SELECT f.home, f.ts, f.ts::DATE AS day, f.occupied FROM fused f
WHERE EXISTS (SELECT 1 FROM roles r
  WHERE r.home = f.home AND r.day = f.ts::DATE AND r.role = 'train')""",
    "day_intersection": f"""WITH {INFERENCES}
SELECT home, day FROM inf WHERE audio = 1
INTERSECT
SELECT home, day FROM (SELECT home, hub, day FROM inf WHERE img = 1
  GROUP BY 1, 2, 3 HAVING count(*) > 1)""",
    "awake_samples": f"""WITH {INFERENCES}
SELECT home, hub, count(*) AS n_samples, sum(occupied)::BIGINT AS n_occupied FROM inf
WHERE hr_min_sec >= '06:00:00' GROUP BY 1, 2""",
    "or_baseline": f"""WITH {fused()}
SELECT home, ts, round({OR_AI}, 9) AS prob_ai, ({OR_AI} > 0.5)::INT AS pred_ai,
  round({OR_AIE}, 9) AS prob_aie, ({OR_AIE} > 0.5)::INT AS pred_aie, occupied FROM fused""",
    "nonparametric_model": f"""WITH {LOOKUP}
SELECT home, weekend, tod_min, round(prob_np, 9) AS prob_np FROM model""",
    "nonparametric_pred": f"""WITH {OWN_HOME}
SELECT home, ts, occupied, round(prob_np, 9) AS prob_np, pred AS pred_np FROM own""",
    "score_true_lags": f"""WITH {SCORED}
SELECT train, home AS test, ts, series_pos, occupied, round(prob_gt, 9) AS prob_gt,
  (prob_gt > 0.5)::INT AS pred_gt FROM scored""",
    "rollout": f"""WITH RECURSIVE {ROLLED}
SELECT r.series_id, t.series_pos, t.ts, t.occupied, round(r.prob, 9) AS prob_ar, (r.prob > 0.5)::INT AS pred_ar
FROM rolled r JOIN tests t ON r.series_id LIKE '%|' || t.home AND t.series_pos = r.pos""",
    "example_predictions": f"""WITH RECURSIVE {FIVE}
SELECT series_id, series_pos, ts, occupied, {', '.join(f'round(prob_{n}, 9) AS prob_{n}, pred_{n}' for n in FIVE_NAMES.values())} FROM five""",
    "example_cross_home": f"""WITH RECURSIVE {FIVE},
long AS (
  SELECT series_id, occupied, unnest([{', '.join(f"'{n}'" for n in FIVE_NAMES)}]) AS function,
    unnest([{', '.join(f'pred_{n}' for n in FIVE_NAMES.values())}]) AS pred FROM five
)
SELECT series_id, function, {RATES_9}
FROM (SELECT series_id, function, {COUNTS} FROM long GROUP BY 1, 2)""",
    "lr_optimality": optimality(),
    "lr_cv_optimality": optimality(),
    "predictor_metrics": f"""WITH {SCORED},
lookup AS (
  SELECT l.home, weekend, tod_min, avg(occupied) AS prob_np
  FROM lagged l JOIN roles r ON l.home = r.home AND l.day = r.day
  WHERE r.role = 'train' GROUP BY 1, 2, 3
),
long AS (
  SELECT s.train || '|' || s.home AS series_id, s.occupied,
    unnest(['OR (ai)', 'OR (aie)', 'Nonparametric', 'ground truth AR']) AS function,
    unnest([({OR_AI} > 0.5)::INT, ({OR_AIE} > 0.5)::INT,
      CASE WHEN k.prob_np >= 0.5 THEN 1 ELSE 0 END, (prob_gt > 0.5)::INT]) AS pred
  FROM scored s LEFT JOIN lookup k
    ON k.home = s.train AND k.weekend = s.weekend AND k.tod_min = s.tod_min
)
SELECT series_id, function, {RATES_9}
FROM (SELECT series_id, function, {COUNTS} FROM long GROUP BY 1, 2)""",
    "metrics_by_home": f"""WITH {OWN_HOME}
SELECT home, {RATES_9} FROM (SELECT home, {COUNTS} FROM own GROUP BY 1)""",
    "metrics_sigdigits": f"""WITH {OWN_HOME}
SELECT home, {', '.join(f'{sig(RATES[m], d)} AS "{m}"' for m, d in SIG.items())}, tn, fp, fn, tp
FROM (SELECT home, {COUNTS} FROM own GROUP BY 1)""",
    "confusion_table": f"""WITH {fused()}, c AS (
  SELECT home, {COUNTS} FROM (SELECT *, ({OR_AI} > 0.5)::INT AS pred FROM fused) GROUP BY 1)
SELECT home, 'Vacant' AS actual, tn AS "Vacant", fp AS "Occupied" FROM c
UNION ALL SELECT home, 'Occupied', fn, tp FROM c""",
    "cross_home_nonparametric": f"""WITH {MATRIX}
SELECT train, test, "self/cross", function, {RATES_9} FROM scored""",
    "split_direction_nonparametric": f"""WITH {calendar()},{SWEEP_ROLES},
rows_ AS (
  SELECT c.home, c.weekend, c.tod_min, c.occupied, s.split, s.direction, s.role
  FROM cal c JOIN sweep s ON c.home = s.home AND c.day = s.day
),
model AS (
  SELECT home, split, direction, weekend, tod_min, avg(occupied) AS p FROM rows_
  WHERE role = 'train' GROUP BY ALL
),
pred AS (
  SELECT r.*, CASE WHEN m.p >= 0.5 THEN 1 ELSE 0 END AS pred
  FROM rows_ r LEFT JOIN model m ON r.home = m.home AND r.split = m.split
    AND r.direction = m.direction AND r.weekend = m.weekend AND r.tod_min = m.tod_min
  WHERE r.role = 'test'
)
SELECT home, split, direction, 'Nonparametric' AS function, {RATES_9}
FROM (SELECT home, split, direction, {COUNTS} FROM pred GROUP BY 1, 2, 3)""",
    "pivot_train_test": f"""WITH {MATRIX}
SELECT train, {pivot('round("Accuracy", 9)')} FROM scored GROUP BY 1""",
    "f1_pair_pivot": f"""WITH {MATRIX},
labelled AS (
  SELECT train, test, {sig_text('"F1"', 2)} || ' / ' || {sig_text('"F1 neg"', 2)} AS f1s FROM scored
)
SELECT train, {pivot('f1s')} FROM labelled GROUP BY 1""",
    "daily_occupancy": f"""WITH {LOOKUP}
SELECT home, day, role, round(avg(occupied), 9) AS occupied FROM rows_ GROUP BY 1, 2, 3""",
    "relabel_hubs": f"""WITH {TRUTH}
SELECT home, hub, ts, {', '.join(CHANNELS)}, occ_max::DOUBLE AS occupied FROM matched""",
    "label_diff_wide": f"""WITH {TRUTH}
SELECT home, ts, {pivot('occ_max - occupied', 'hub', HUBS)} FROM matched GROUP BY 1, 2""",
    "distinct_hubs": f"WITH {READINGS} SELECT DISTINCT hub FROM readings",
    "design_full": f"WITH {HUB_LIST},{DESIGN} SELECT home, run, {HUB_SIGNS} FROM signs_full "
                   "GROUP BY 1, 2",
    "design_half": f"WITH {HUB_LIST},{DESIGN} SELECT home, run, {HUB_SIGNS} FROM signs_half "
                   "GROUP BY 1, 2",
    "hub_modalities": f"""WITH {HUB_LIST},{DESIGN}
SELECT home, run, hub, sign, CASE sign WHEN 1 THEN 'audio' ELSE 'None' END AS channel
FROM signs_half""",
    "hub_selection": f"""WITH {INFERENCES}
SELECT home, day, hr_min_sec, hub, img, occupied FROM inf WHERE hub = 'RS2'""",
    "ffa_predictions": f"""WITH {INFERENCES},
wide AS (
  SELECT * FROM (SELECT home, day, hr_min_sec, occupied, audio AS audio_1 FROM inf WHERE hub = 'RS1')
  {' '.join(f"FULL JOIN (SELECT home, day, hr_min_sec, occupied, audio AS audio_{i} FROM inf "
            f"WHERE hub = 'RS{i}') USING (home, day, hr_min_sec, occupied)" for i in range(2, 6))}
)
SELECT *, ({' + '.join(f'coalesce({c}, 0)' for c in AUDIO_COLUMNS)} > 0)::INT AS pred FROM wide
WHERE {' AND '.join(f'coalesce({c}, 0) <> -1' for c in AUDIO_COLUMNS)}""",
    "ffa_daily_metrics": f"""WITH {model_free('img', 'audio')}
SELECT home, run, day, tn, fp, fn, tp, "FPR", "TPR", "FNR", "TNR",
  round("F1-Score", 9) AS "F1-Score", round("Accuracy", 9) AS "Accuracy" FROM daily""",
    "ffa_run_stats": f"""WITH {model_free('audio', 'None')},{RUN_STATS}
SELECT home, run, {', '.join(r9(f'"{m}"', m, 7) for m in (*DAILY, *(f'var {d}' for d in DAILY)))}
FROM stats""",
    "ffa_standard_error": f"""WITH {model_free('img', 'audio')},{RUN_STATS},{STANDARD_ERRORS}
SELECT home, {', '.join(r9(f'"{m}"', m) for m in DAILY)} FROM errs""",
    "ffa_report": f"""WITH {model_free('img', 'audio')},{RUN_STATS},{STANDARD_ERRORS},
named AS (
  SELECT home, run, {HUB_SIGNS}, 'Run ' || run || ': {{' || string_agg('''' || hub || ''': ''' ||
    CASE sign WHEN 1 THEN 'img' ELSE 'audio' END || '''', ', ' ORDER BY hub) || '}}' AS "Name"
  FROM signs_full GROUP BY 1, 2
)
SELECT n.home, n.run::VARCHAR AS "Run", {', '.join(HUBS)}, "Name",
  {', '.join(r9(f's."{m}"', m) for m in DAILY)}
FROM named n JOIN stats s ON n.home = s.home AND n.run = s.run
UNION ALL
SELECT home, 'SE', {', '.join('NULL' for _ in HUBS)}, NULL,
  {', '.join(f'round("{m}", 9)' for m in DAILY)} FROM errs""",
    "sentinel_value_counts": value_counts("img", "audio"),
    "silent_value_counts": value_counts("audio", "None"),
    "look_ahead": f"""WITH {INFERENCES},
timed AS (
  SELECT home, hub, day, substr(hr_min_sec, 1, 2)::INT AS sample_no, audio, img, occupied,
    round_even((2 - 0.25::DOUBLE) / 2 * cos(substr(hr_min_sec, 1, 2)::INT * 2 * pi() / 24)
      + (2 - 0.25::DOUBLE) / 2 + 0.25::DOUBLE, 0) AS hold
  FROM inf
)
SELECT home, hub, day, sample_no, {LOOK_AHEAD}, occupied FROM timed""",
    "ffa_features": f"""WITH {run_series('audio', 'None')}
SELECT home, run, ts, {each('round({}, 9) AS {}')}, occupied FROM series""",
    "main_effects": f"WITH {RUN_METRICS} {effect_query('singles')}",
    "interaction_effects": f"WITH {RUN_METRICS} {effect_query('pairs', 'm.run <> 0')}",
    "effects_table": f"""WITH {RUN_METRICS}
SELECT home, 'BL' AS factor, {', '.join(r9(f'max("{m}")::DOUBLE', m) for m in METRICS)}
FROM run_metrics WHERE run = 0 GROUP BY 1
UNION ALL
SELECT home, 'avg', {', '.join(f'round(avg("{m}"), 9)' for m in METRICS)}
FROM run_metrics WHERE run <> 0 GROUP BY 1
UNION ALL {effect_query('singles')} UNION ALL {effect_query('pairs')}""",
    "ffa_features_full": f"""WITH {run_series('audio', 'None', 'signs_full')}
SELECT home, run, ts, {each('round({}, 9) AS {}')}, occupied FROM series""",
    "main_effects_full": f"WITH {FULL_RUN_METRICS} {effect_query('singles')}",
    "interaction_effects_full": f"WITH {FULL_RUN_METRICS} {effect_query('pairs', 'm.run <> 0')}",
    "effects_table_full": f"""WITH {FULL_RUN_METRICS}
SELECT home, 'BL' AS factor, {', '.join(r9(f'max("{m}")::DOUBLE', m) for m in METRICS)}
FROM run_metrics WHERE run = 0 GROUP BY 1
UNION ALL
SELECT home, 'avg', {', '.join(f'round(avg("{m}"), 9)' for m in METRICS)}
FROM run_metrics WHERE run <> 0 GROUP BY 1
UNION ALL {effect_query('singles')} UNION ALL {effect_query('pairs')}""",
    "grid_features": grid_features(),
    "grid_lags": grid_lags(),
    "grid_effects": grid_effects(),
    "hub_sign_rows": f"""WITH {RUN_METRICS}
SELECT s.home, s.run, round(m."F1", 9) AS "F1", s.factor AS hub, s.sign
FROM singles s JOIN run_metrics m ON s.home = m.home AND s.run = m.run""",
    "configured_hubs": f"""WITH {READINGS}
SELECT DISTINCT r.home, r.hub, t.threshold AS zone_threshold
FROM readings r JOIN (VALUES {HUB_THRESHOLDS}) t(home, hub, threshold) ON r.home = t.home AND r.hub = t.hub""",
    "configured_days": f"""WITH {READINGS}
SELECT DISTINCT home, unnest(generate_series(a, z, INTERVAL '1 day'))::DATE AS day
FROM (SELECT home, hub, min(ts)::DATE AS a, max(ts)::DATE AS z FROM readings GROUP BY 1, 2)""",
    "date_ranges_file": f"""WITH {READINGS}
SELECT home, min(ts)::DATE AS "start", max(ts)::DATE AS "end" FROM readings GROUP BY 1""",
    "results_read_back": f"""WITH {OWN_HOME}
SELECT home, {RATES_9} FROM (SELECT home, {COUNTS} FROM own GROUP BY 1)""",
    "coefficients_read_back": f"""WITH {LOOKUP},{channel_means('test')}
SELECT term, train_home, round(value, 9) AS value FROM coefs""",
    "run_record": f"""WITH {READINGS}
SELECT home, string_agg(DISTINCT hub, ',' ORDER BY hub) AS hubs, 'zeros' AS fill,
  '{{"penalty":"l1","max_iter":"5000","C":"0.1"}}' AS params, 0 AS cv, 0.1::DOUBLE AS best_c
FROM readings GROUP BY 1""",
    "coeff_summary": f"""WITH {LOOKUP},{channel_means('train')},
{summary('coefs', 'summary', "train_home <> 'H4'")}
SELECT term, {', '.join(r9(c, c, 7) for c in SUMMARY)} FROM summary""",
    "coeff_summary_compat": f"""WITH {COMPAT}
SELECT term, {', '.join(r9(c, c, 7) for c in SUMMARY)} FROM final""",
    "coeff_join": f"""WITH {LOOKUP},{channel_means('train', 'a')},{channel_means('test', 'b')},
{summary('a', 'sa')},{summary('b', 'sb')}
SELECT sa.term, {', '.join(r9(f'sa.{c}', c, 7) for c in JOINED)},
  {', '.join(r9(f'sb.{c}', c + '_cv', 7) for c in JOINED)}
FROM sa LEFT JOIN sb ON sa.term = sb.term""",
    "coeff_order": f"""WITH {LOOKUP},{channel_means('train')}
SELECT term, {pivot('round(value, 9)', 'train_home')} FROM coefs GROUP BY 1
ORDER BY list_position([{INTERLEAVED_TERMS}], term)""",
    "sig_labels": f"""WITH {LOOKUP},{channel_means('test')}
SELECT train_home, term, {sig_text('round(value, 9)', 2)} AS text FROM coefs""",
}
