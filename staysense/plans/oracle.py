"""DuckDB twins of the registered queries (the correctness oracle).

Plain SQL over the pre-registered driver tables.  The rules' numbers, names and tables are written out
here once more, not taken from the engine, so that a wrong constant there shows.
Fixture views are CTEs (FIXTURES.md §2).  Numeric literals are cast to DOUBLE
and expression trees follow the same association as the Spark side so IEEE
results agree; money sums go through DECIMAL exactly as on the Spark side.
"""

from __future__ import annotations

class K:
    # fixed values: those of the rules
    DEFAULT_NIGHTS = 2
    DEFAULT_GUESTS = 2
    DEFAULT_RATE = 250.0
    DEFAULT_BOARD = "SC"
    DEFAULT_FALLBACK_THRESHOLD = 0.4912
    GIFT_UNIT_COSTS = {"A": 4.0, "B": 0.09, "C": 7.0, "D": 9.0}
    GIFT_NAMES = {"A": "Desayuno", "B": "Mejora habitación", "C": "Parking", "D": "Spa"}
    NO_GIFT_NAME = "Sin regalo (bajo riesgo o no rentable)"
    SEGMENT_UPPER_BOUNDS = [0.6, 0.7, 0.8, 0.9, 1.0]
    UNKNOWN_CONTINENT = "Desconocido"
    CONTINENT_MAP_TRAINING = {
        "SPA": "Europa", "FRA": "Europa", "POR": "Europa", "AUT": "Europa",
        "NLD": "Europa", "ITA": "Europa", "GBR": "Europa", "DEU": "Europa",
        "DNK": "Europa", "POL": "Europa", "BEL": "Europa", "FIN": "Europa",
        "NOR": "Europa", "HUN": "Europa", "CHE": "Europa", "ROU": "Europa",
        "SWE": "Europa", "UKR": "Europa", "GRC": "Europa", "IRL": "Europa",
        "JPN": "Asia", "ISR": "Asia", "CHN": "Asia", "IND": "Asia",
        "IRN": "Asia", "IRQ": "Asia", "PHL": "Asia", "MYS": "Asia",
        "SGP": "Asia", "TWN": "Asia", "THA": "Asia", "KOR": "Asia",
        "AGO": "África", "CMR": "África", "DZA": "África", "EGY": "África",
        "MAR": "África", "ZAF": "África", "MOZ": "África", "TUN": "África",
        "USA": "América del Norte", "MEX": "América del Norte", "CAN": "América del Norte", "CUB": "América del Norte",
        "DOM": "América del Norte", "PRI": "América del Norte", "BRA": "América del Sur", "ARG": "América del Sur",
        "ECU": "América del Sur", "COL": "América del Sur", "PER": "América del Sur", "URY": "América del Sur",
        "VEN": "América del Sur", "CHL": "América del Sur", "BOL": "América del Sur", "AUS": "Oceanía",
        "NZL": "Oceanía", "PYF": "Oceanía", "NCL": "Oceanía", "FJI": "Oceanía",
        "CN": "Otros",
    }
    CONTINENT_MAP_SCORING = {
        "SPA": "Europa", "FRA": "Europa", "POR": "Europa", "USA": "América del Norte",
        "MEX": "América del Norte", "BRA": "América del Sur", "ARG": "América del Sur", "CHN": "Asia",
        "JPN": "Asia", "AUS": "Oceanía", "NZL": "Oceanía",
    }
    LEAD_TIME_EDGES = [-1, 7, 30, 90, 180]
    LEAD_TIME_LABELS = ["last_minute", "short", "medium", "long", "very_long"]
    STAY_EDGES = [-1, 1, 3, 7, 14]
    STAY_LABELS = ["1_night", "2-3_nights", "4-7_nights", "8-14_nights", "15+_nights"]
    QUANTILE_LOW = 0.05
    QUANTILE_HIGH = 0.95
    KNN_NEIGHBORS = 5
    SMOTE_RATIO = 0.8
    POSITIVE_CLASS_WEIGHT = 1.5
    GROUP_FOLDS = 7
    SEED = 42
    VARIANCE_THRESHOLD = 0.001
    ANOVA_TOP_K = 22
    TEST_FRACTION = 0.2
    GRID_START = 0.3
    GRID_STOP = 0.7
    GRID_STEP = 0.01
    SWEEP_START = 0.1
    SWEEP_STOP = 0.8
    SWEEP_NUM = 40


# fixed values: scorecard (intercept, lead time, nights, requests, foreign), codes by nation key
COEFFICIENTS = (-2.0, 0.012, 0.1, -0.3, 0.5)
COUNTRY_CODES = [
    "SPA", "FRA", "POR", "GBR", "DEU", "ITA", "USA", "MEX", "BRA", "ARG",
    "CHN", "JPN", "AUS", "NZL", "MAR", "EGY", "CN", "XXX", "ZZZ", "NLD",
    "SWE", "CAN", "PER", "IND", "ZAF",
]


def arange(start: float, stop: float, step: float) -> list[float]:
    """NumPy's steps: each value is the start and so many times the first difference."""
    first = (start + step) - start
    return [start + i * first for i in range(round((stop - start) / step))]


def linspace(start: float, stop: float, num: int) -> list[float]:
    return [start + i * ((stop - start) / (num - 1)) for i in range(num - 1)] + [stop]


THR = K.DEFAULT_FALLBACK_THRESHOLD
AS_OF = "2000-01-01 00:00:00"


def D(x) -> str:
    return f"CAST({x!r} AS DOUBLE)" if isinstance(x, float) else f"CAST({x} AS DOUBLE)"


def H(key_sql: str, seed: int = K.SEED) -> str:
    return f"('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || '|{seed}'), 1, 15))::BIGINT"


def flag(pred: str) -> str:
    return f"CAST(coalesce({pred}, false) AS INTEGER)"


def lst(vals) -> str:
    return "[" + ", ".join(D(float(v)) for v in vals) + "]"


def case_map(col: str, mapping: dict, default: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {arms} ELSE '{default}' END"


_CODES = ", ".join(f"'{c}'" for c in COUNTRY_CODES)

HOTELS = f"""hotels AS (
  SELECT concat('h', CAST(s_suppkey AS VARCHAR)) AS hotel_id,
         CASE WHEN s_suppkey % 2 = 0 THEN 'City Hotel' ELSE 'Resort Hotel' END AS hotel_type,
         ([{_CODES}])[s_nationkey + 1] AS country,
         s_suppkey % 3 = 0 AS parking,
         CAST(39 + (s_suppkey % 10) * 10 AS INT) AS total_rooms,
         s_suppkey % 4 <> 0 AS restaurant,
         s_suppkey % 5 <> 0 AS pool_and_spa,
         CAST(340 + (s_suppkey % 10) * 14 AS DOUBLE) / CAST(100 AS DOUBLE) AS avg_review
  FROM supplier)"""

BOOKINGS = f"""b0 AS (
  SELECT o.*, c.c_nationkey, CAST(o_orderkey AS INT) AS k, coalesce(hotel_key, -1) AS hotel_key,
         o_orderdate + to_days(CAST((o_orderkey * 7) % 200 AS INT)) AS arr
  FROM orders o JOIN customer c ON o_custkey = c_custkey
  LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS hotel_key FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey),
bookings AS (
  SELECT o_orderkey AS booking_id,
         concat('h', CAST(hotel_key AS VARCHAR)) AS hotel_id,
         CASE WHEN k % 97 = 0 THEN NULL
              WHEN o_orderstatus = 'F' THEN 'Check-Out'
              WHEN o_orderstatus = 'P' THEN 'Canceled'
              WHEN k % 3 = 0 THEN 'Booked'
              WHEN k % 3 = 1 THEN 'No-Show' ELSE 'Check-Out' END AS reservation_status,
         o_orderdate AS booking_date,
         arr AS arrival_date,
         arr + to_days(CAST(5 - (k * 13) % 60 AS INT)) AS reservation_status_date,
         CASE WHEN k % 53 = 0 THEN NULL ELSE o_totalprice / CAST(100 AS DOUBLE) END AS rate,
         CASE WHEN k % 59 = 0 THEN NULL ELSE CAST(k % 16 AS DOUBLE) END AS stay_nights,
         CASE WHEN k % 61 = 0 THEN NULL ELSE CAST(1 + k % 5 AS DOUBLE) END AS total_guests,
         CASE WHEN k % 2 = 0 THEN NULL ELSE CAST(k % 3 AS DOUBLE) END AS required_car_parking_spaces,
         CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(k % 4 AS DOUBLE) END AS special_requests,
         CASE k % 6 WHEN 0 THEN 'BB' WHEN 1 THEN 'HB' WHEN 2 THEN 'FB' WHEN 3 THEN NULL ELSE 'SC' END AS board,
         CASE WHEN k % 31 = 0 THEN NULL ELSE ([{_CODES}])[c_nationkey + 1] END AS country
  FROM b0)"""

MERGED = """merged AS (
  SELECT b.booking_id, b.hotel_id, b.reservation_status, b.booking_date, b.arrival_date,
         b.reservation_status_date, b.rate, b.stay_nights, b.total_guests, b.required_car_parking_spaces,
         b.special_requests, b.board, b.country AS country_x, h.hotel_type, h.country AS country_y,
         h.parking, h.total_rooms, h.restaurant, h.pool_and_spa, h.avg_review
  FROM bookings b LEFT JOIN hotels h ON b.hotel_id = h.hotel_id)"""

BASE = f"WITH {HOTELS},\n{BOOKINGS},\n{MERGED}"


def closed_cte(policy: str = "b", name: str = "closed") -> str:
    where = "reservation_status <> 'Booked'" if policy == "a" else "reservation_status IS DISTINCT FROM 'Booked'"
    status = ("CASE WHEN reservation_status = 'No-Show' THEN 'Check-Out' ELSE reservation_status END"
              if policy == "b" else "reservation_status")
    sr = "special_requests" if policy == "b" else "coalesce(special_requests, 0)"
    s, d = "reservation_status", "days_before_arrival"
    target = {"a": f"{s} = 'Canceled' AND {d} <= 30 AND {d} >= 0",
              "b": f"{s} = 'Canceled' AND {d} <= 30",
              "c": f"{s} IN ('Canceled', 'No-Show') AND {d} <= 30"}[policy]
    return f"""{name}_0 AS (
  SELECT * REPLACE ({status} AS reservation_status,
                    coalesce(required_car_parking_spaces, 0) AS required_car_parking_spaces,
                    {sr} AS special_requests),
         date_diff('day', booking_date, arrival_date) AS lead_time,
         date_diff('day', reservation_status_date, arrival_date) AS days_before_arrival
  FROM merged WHERE {where}),
{name} AS (SELECT *, {flag(target)} AS target FROM {name}_0)"""


IS_FOREIGN = flag("country_x <> country_y")


def scorecard_sql() -> str:
    b0, bl, bn, br, bf = COEFFICIENTS
    z = (f"((({D(b0)} + {D(bl)} * coalesce(lead_time, 0)) + {D(bn)} * coalesce(stay_nights, {D(0.0)}))"
         f" + {D(br)} * coalesce(special_requests, {D(0.0)})) + {D(bf)} * {IS_FOREIGN}")
    return f"round({D(1.0)} / ({D(1.0)} + exp(-({z}))), 6)"


SCORED = f"""scored AS (
  SELECT *, target AS label, {scorecard_sql()} AS score FROM closed)"""

BASE_SCORED = f"{BASE},\n{closed_cte('b')},\n{SCORED}"


def mode_sql(col: str, src: str = "merged") -> str:
    return (f"(SELECT v FROM (SELECT {col} AS v, count(*) AS c FROM {src} WHERE {col} IS NOT NULL GROUP BY 1)"
            f" ORDER BY c DESC, v ASC LIMIT 1)")


def pct(num: str, den: str, scale: int = 4) -> str:
    return f"round((CAST({num} AS DOUBLE) * {D(100.0)}) / CAST({den} AS DOUBLE), {scale})"


# ----------------------------------------------------------------- inference + gifts
INFERENCE = f"""inf0 AS (
  SELECT * REPLACE (coalesce(required_car_parking_spaces, 0) AS required_car_parking_spaces),
         date_diff('day', booking_date, arrival_date) AS lead_time
  FROM merged),
inf AS (SELECT *, {scorecard_sql()} AS cancellation_probability FROM inf0),
inf2 AS (SELECT *, CAST(cancellation_probability >= {D(THR)} AS INTEGER) AS predicted_to_cancel FROM inf)"""


def imputed_cte(src: str = "inf2", name: str = "imp") -> str:
    means = ["special_requests", "total_rooms", "avg_review"]
    modes_ = ["reservation_status", "reservation_status_date", "country_x", "hotel_type", "country_y",
              "parking", "restaurant", "pool_and_spa"]
    fills = ",\n         ".join([f"coalesce({c}, {mean_exact(c, src)}) AS {c}" for c in means] +
                               [f"coalesce({c}, {mode_sql(c, src)}) AS {c}" for c in modes_])
    return f"""{name} AS (
  SELECT * REPLACE (
         CAST(trunc(coalesce(stay_nights, {D(float(K.DEFAULT_NIGHTS))})) AS INTEGER) AS stay_nights,
         CAST(trunc(coalesce(total_guests, {D(float(K.DEFAULT_GUESTS))})) AS INTEGER) AS total_guests,
         coalesce(rate, {D(K.DEFAULT_RATE)}) AS rate,
         coalesce(board, '{K.DEFAULT_BOARD}') AS board,
         coalesce(required_car_parking_spaces, 0) AS required_car_parking_spaces,
         {fills},
         coalesce(arrival_date, TIMESTAMP '{AS_OF}' + to_days(30)) AS arrival_date)
  FROM {src})"""


def gift_exprs(match: str = "as_coded") -> dict:
    p = "cancellation_probability"
    city = "false" if match == "as_coded" else "coalesce(contains(lower(hotel_type), 'city hotel'), false)"
    resort = "false" if match == "as_coded" else "coalesce(contains(lower(hotel_type), 'resort hotel'), false)"
    tf = (f"CASE WHEN coalesce((isodow(arrival_date) - 1) IN (3, 4, 5) AND stay_nights >= 1 AND stay_nights <= 3, false)"
          f" THEN {D(0.5)} ELSE {D(0.35)} END")
    hf = f"CASE WHEN {city} THEN {D(0.7)} ELSE {D(0.55)} END"
    rf = f"least({D(1.0)}, {D(0.2)} * avg_review)"
    repl = f"(({tf}) * ({hf})) * ({rf})"
    replaced = f"(rate * ({repl}))"
    ev_none = f"((({D(1.0)} - {p}) * rate) + ({p} * {replaced}))"
    c = K.GIFT_UNIT_COSTS
    cost = {"A": f"(({D(c['A'])} * total_guests) * stay_nights + {D(5.0)})",
            "B": f"({D(c['B'])} * rate + {D(5.0)})",
            "C": f"({D(c['C'])} * stay_nights + {D(5.0)})",
            "D": f"({D(c['D'])} * total_guests + {D(5.0)})"}
    succ = {"A": f"least({D(1.0)}, sqrt(total_guests * stay_nights) / {D(4.0)})",
            "B": f"CASE WHEN {city} THEN {D(0.8)} ELSE {D(0.65)} END",
            "C": D(0.5),
            "D": f"CASE WHEN {resort} THEN {D(0.7)} ELSE {D(0.55)} END"}
    elig = {"A": "(NOT coalesce(board IN ('BB', 'FB', 'HB'), false) AND coalesce(restaurant, false))",
            "B": "coalesce(total_rooms > 80, false)", "C": "coalesce(parking, false)",
            "D": "coalesce(pool_and_spa, false)"}
    ev = {g: (f"(((({D(1.0)} - {p}) + {p} * ({succ[g]})) * rate + ({p} * ({D(1.0)} - ({succ[g]}))) * {replaced})"
              f" - {cost[g]})") for g in "ABCD"}
    return {"ev_none": ev_none, "cost": cost, "succ": succ, "elig": elig, "ev": ev}


def decided_cte(match: str = "as_coded") -> str:
    e = gift_exprs(match)
    p = "cancellation_probability"
    steps = [f"""g0 AS (SELECT *, {e['ev_none']} AS ev_no_intervention, CAST(NULL AS VARCHAR) AS bg,
       {e['ev_none']} AS be, {D(0.0)} AS bc FROM imp)"""]
    prev = "g0"
    for i, g in enumerate("ABCD", 1):
        better = f"({e['elig'][g]} AND coalesce({e['ev'][g]} > be, false))"
        steps.append(f"""g{i} AS (SELECT * REPLACE (CASE WHEN {better} THEN '{g}' ELSE bg END AS bg,
       CASE WHEN {better} THEN {e['cost'][g]} ELSE bc END AS bc,
       CASE WHEN {better} THEN {e['ev'][g]} ELSE be END AS be) FROM {prev})""")
        prev = f"g{i}"
    steps.append(f"""decided AS (SELECT *,
       CASE WHEN {p} >= {D(THR)} THEN bg END AS gift,
       CASE WHEN {p} >= {D(THR)} THEN bc ELSE {D(0.0)} END AS cost_of_selected_gift,
       CASE WHEN {p} >= {D(THR)} THEN be ELSE ev_no_intervention END AS final_ev_with_gift_decision
       FROM {prev})""")
    return ",\n".join(steps)


def base_decided(match: str = "as_coded") -> str:
    return f"{BASE},\n{INFERENCE},\n{imputed_cte()},\n{decided_cte(match)}"


def mean_exact(x: str, src: str) -> str:
    return f"(SELECT CAST(sum(CAST({x} AS DECIMAL(38,12))) AS DOUBLE) / CAST(count({x}) AS DOUBLE) FROM {src})"


def sum_exact(x: str) -> str:
    return f"CAST(sum(CAST(round({x}, 6) AS DECIMAL(18,6))) AS DOUBLE)"


# ------------------------------------------------------------------------- queries
def _quantiles(col: str, probs, src: str = "merged") -> str:
    return f"quantile_cont({col}, {lst(probs)}) FROM {src}"


def _capping(method: str) -> str:
    cols = ["rate", "total_guests", "stay_nights"]
    probs = [0.25, 0.75] if method == "iqr" else [K.QUANTILE_LOW, K.QUANTILE_HIGH]
    qs = ",\n".join(f"q_{c} AS (SELECT {_quantiles(c, probs)})" for c in cols)
    bounds = []
    for c in cols:
        a, b = f"(SELECT q[1] FROM (SELECT {_quantiles(c, probs)}) t(q))", f"(SELECT q[2] FROM (SELECT {_quantiles(c, probs)}) t(q))"
        if method == "iqr":
            bounds.append((c, f"({a} - {D(1.5)} * ({b} - {a}))", f"({b} + {D(1.5)} * ({b} - {a}))"))
        else:
            bounds.append((c, a, b))
    del qs
    return bounds


def _cap_sql(method: str) -> str:
    sel = ", ".join(f"round(CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, {lo}), {hi}) END, 8) AS {c}"
                    for c, lo, hi in _capping(method))
    return f"{BASE}\nSELECT booking_id, {sel} FROM merged"


def _outlier_counts_sql() -> str:
    parts = []
    for c, lo, hi in _capping("iqr"):
        parts.append(f"SELECT '{c}' AS column, round({lo}, 6) AS lower, round({hi}, 6) AS upper, "
                     f"count_if({c} < {lo} OR {c} > {hi}) AS outliers FROM merged")
    return f"{BASE}\n" + "\nUNION ALL\n".join(parts)


def _band(x: str, edges, labels) -> str:
    arms = []
    for i, lab in enumerate(labels):
        lo = edges[i]
        cond = f"{x} > {lo} AND {x} <= {edges[i + 1]}" if i + 1 < len(edges) else f"{x} > {lo}"
        arms.append(f"WHEN {cond} THEN '{lab}'")
    return "CASE " + " ".join(arms) + " END"


def _curve(src: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    sel = f"{by}, " if by else ""
    return f"""g AS (SELECT {sel}score AS s, CAST(sum(label) AS BIGINT) AS pos, CAST(count(*) - sum(label) AS BIGINT) AS neg
       FROM {src} WHERE score IS NOT NULL GROUP BY {sel}score),
c AS (SELECT {sel}s, pos, neg,
       sum(pos) OVER ({part}ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
       sum(neg) OVER ({part}ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
       sum(pos) OVER ({'PARTITION BY ' + by if by else ''}) AS P,
       sum(neg) OVER ({'PARTITION BY ' + by if by else ''}) AS N FROM g)"""


def _fbeta_sql(beta: float, by: str = "", src: str = "scored") -> str:
    b2 = float(beta) ** 2
    f = f"""f AS (SELECT *, CASE WHEN prec + rec > 0 THEN ({D(1.0 + b2)} * prec * rec) / ({D(b2)} * prec + rec)
       ELSE {D(0.0)} END AS fb FROM (SELECT *, CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS prec,
       CASE WHEN P > 0 THEN CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) ELSE {D(0.0)} END AS rec FROM c))"""
    if by:
        return f"""{_curve(src, by)},
{f},
r AS (SELECT {by}, s, fb, row_number() OVER (PARTITION BY {by} ORDER BY fb DESC, s ASC) AS rn FROM f)
SELECT {by}, round(s, 6) AS threshold, round(fb, 6) AS fbeta FROM r WHERE rn = 1"""
    return f"""{_curve(src)},
{f}
SELECT round(coalesce((SELECT s FROM f ORDER BY fb DESC, s ASC LIMIT 1), {D(0.5)}), 6) AS threshold,
       round(coalesce((SELECT max(fb) FROM f), {D(0.0)}), 6) AS fbeta"""


def _grid_table(grid, src: str = "scored") -> str:
    vals = ", ".join(f"({i}, {D(float(t))})" for i, t in enumerate(grid))
    return f"""gt AS (SELECT * FROM (VALUES {vals}) v(i, threshold)),
tt AS (SELECT i, threshold,
       count_if(label = 1 AND score >= threshold) AS tp, count_if(label = 0 AND score >= threshold) AS fp,
       count_if(label = 1 AND score < threshold) AS fn, count_if(label = 0 AND score < threshold) AS tn
       FROM gt CROSS JOIN (SELECT label, score FROM {src} WHERE score IS NOT NULL) GROUP BY i, threshold),
m AS (SELECT *,
       CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE {D(0.0)} END AS precision,
       CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE {D(0.0)} END AS recall,
       CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE) ELSE {D(0.0)} END AS f1
       FROM tt)"""


def _metric_cols(tn="tn", fp="fp", fn="fn", tp="tp") -> str:
    def r(n, d):
        return f"round(CASE WHEN ({d}) > 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) ELSE {D(0.0)} END, 6)"
    return ", ".join([f"{r(f'{tp} + {tn}', f'{tp} + {tn} + {fp} + {fn}')} AS accuracy",
                      f"{r(tp, f'{tp} + {fp}')} AS precision", f"{r(tp, f'{tp} + {fn}')} AS recall",
                      f"{r(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}')} AS f1",
                      f"{r(tn, f'{tn} + {fp}')} AS specificity", f"{r(fp, f'{tn} + {fp}')} AS false_alarm_rate",
                      f"{r(fn, f'{fn} + {tp}')} AS miss_rate"])


def _group_folds_cte(src: str, label: str = "target", k: int = K.GROUP_FOLDS) -> str:
    return f"""grp AS (SELECT hotel_id, sum({label}) AS gpos, count(*) AS gn, {H('hotel_id')} AS gh FROM {src} GROUP BY hotel_id),
grk AS (SELECT hotel_id, row_number() OVER (ORDER BY gpos DESC, gn DESC, gh, hotel_id) - 1 AS r0 FROM grp),
gf AS (SELECT hotel_id, CAST(CASE WHEN (r0 // {k}) % 2 = 0 THEN r0 % {k} ELSE {k - 1} - r0 % {k} END AS INTEGER) AS fold FROM grk)"""


def _even_folds_cte(src: str, label: str = "target", k: int = K.GROUP_FOLDS) -> str:
    """One step of the recursion per group: p and n hold each fold's positives and negatives."""
    def dev(v: str, g: str, t: str) -> str:
        held = f"list_transform({v}, lambda a, j: a + CASE WHEN j = f THEN {g} ELSE 0 END)"
        return (f"CASE WHEN {t} = 0 THEN {D(0.0)} ELSE sqrt(greatest(CAST({k} AS DOUBLE) * list_sum(list_transform({held}, "
                f"lambda a: CAST(a AS DOUBLE) * a)) - CAST(list_sum({held}) AS DOUBLE) * CAST(list_sum({held}) AS DOUBLE), {D(0.0)})) "
                f"/ CAST({t} AS DOUBLE) END")
    choice = (f"list_sort(list_transform(range(1, {k + 1}), lambda f: struct_pack(d := CAST(floor((({dev('n', 'gneg', 'tneg')}) + "
              f"({dev('p', 'gpos', 'tpos')})) * CAST(1e9 AS DOUBLE)) AS BIGINT), h := n[f] + p[f], f := f)))[1].f")
    zero = "[" + ", ".join(["CAST(0 AS BIGINT)"] * k) + "]"
    return f"""grp AS (SELECT hotel_id, CAST(sum({label}) AS BIGINT) AS gpos, CAST(count(*) - sum({label}) AS BIGINT) AS gneg, {H('hotel_id')} AS gh
        FROM {src} GROUP BY hotel_id),
grk AS MATERIALIZED (SELECT hotel_id, gpos, gneg, CAST(sum(gpos) OVER () AS BIGINT) AS tpos, CAST(sum(gneg) OVER () AS BIGINT) AS tneg,
        row_number() OVER (ORDER BY abs(gpos - gneg) DESC, gh, hotel_id) AS rn FROM grp),
st(i, p, n, fold) AS (SELECT CAST(0 AS BIGINT), {zero}, {zero}, CAST(0 AS BIGINT)
  UNION ALL
  SELECT rn, list_transform(p, lambda a, j: a + CASE WHEN j = pick THEN gpos ELSE 0 END),
         list_transform(n, lambda a, j: a + CASE WHEN j = pick THEN gneg ELSE 0 END), pick
  FROM (SELECT g.rn, s.p, s.n, g.gpos, g.gneg, CAST({choice} AS BIGINT) AS pick FROM st s JOIN grk g ON g.rn = s.i + 1)),
gf AS (SELECT g.hotel_id, CAST(s.fold - 1 AS INTEGER) AS fold FROM grk g JOIN st s ON s.i = g.rn)"""


def _bigint_counts(sql: str) -> str:
    """DuckDB's count_if is HUGEINT; cast every occurrence to BIGINT like Spark's."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k] + " AS BIGINT)")
        i = k


# ------------------------------------------------------------------ boosting
def boosted_ctes(rounds: int = 2, depth: int = 6, step: float = 0.05, child: float = 4.0, gamma: float = 0.1) -> str:
    """Rows, cut points and bins, then level by level a chain of windows: sums by node, feature and bin, the best cut of
    each node, the node that a row comes to.  Each step reads the one before it once."""
    features = ["rate", "stay_nights", "total_guests", "required_car_parking_spaces", "special_requests", "lead_time",
                "total_rooms", "avg_review", "parking", "restaurant", "pool_and_spa"]
    scale = "CAST(268435456 AS DOUBLE)"
    one = D(1.0)
    rank = f"row_number() OVER (PARTITION BY target ORDER BY {H('booking_id')}, booking_id)"
    pairs = ", ".join(f"struct_pack(f := {i}, feature := '{f}', x := CAST({f} AS DOUBLE))" for i, f in enumerate(features))
    parts = [f"""ranked AS (SELECT *, {rank} AS rn, count(*) OVER (PARTITION BY target) AS n FROM closed),
long AS MATERIALIZED (SELECT id, y, is_test, u.f AS f, u.feature AS feature, u.x AS x FROM (
  SELECT booking_id AS id, target AS y, CASE WHEN rn <= round(CAST(n AS DOUBLE) * {D(0.2)}) THEN 1 ELSE 0 END AS is_test,
  unnest([{pairs}]) AS u FROM ranked)),
vals AS (SELECT f, list(x ORDER BY x) AS v FROM long WHERE is_test = 0 AND x IS NOT NULL GROUP BY f),
cuts AS MATERIALIZED (SELECT f, list_sort(list_distinct(list_transform(range(256),
  lambda i: v[greatest(1, CAST(ceil(CAST(i * len(v) AS DOUBLE) / CAST(256 AS DOUBLE)) AS BIGINT))]))) AS c FROM vals),
bins AS MATERIALIZED (SELECT f, x, len(list_filter(c, lambda z: z < x)) AS bin FROM (SELECT DISTINCT f, x FROM long WHERE x IS NOT NULL)
  JOIN cuts USING (f)),
e0 AS (SELECT id, y, is_test, long.f, feature, coalesce(bin, -1) AS bin, CAST(0 AS DOUBLE) AS m0
  FROM long LEFT JOIN bins ON bins.f = long.f AND bins.x = long.x)"""]
    for r in range(rounds):
        p = f"({one} / ({one} + exp(-m{r})))"
        parts.append(f"""r{r}_0 AS (SELECT *, 1 AS n{r}_0, CASE WHEN is_test = 0 THEN CAST(floor(({p} - y) * {scale} + {D(0.5)}) AS BIGINT) ELSE 0 END AS g,
  CASE WHEN is_test = 0 THEN CAST(floor({p} * ({one} - {p}) * {scale} + {D(0.5)}) AS BIGINT) ELSE 0 END AS h FROM e{r})""")
        for d in range(depth):
            k, node = f"{r}_{d}", f"n{r}_{d}"

            def gain(lost: str) -> str:
                gl, hl = (f"(CAST({c}s{lost and f' + {c}m'} AS DOUBLE) / {scale})" for c in "gh")
                ga, ha = (f"(CAST({c}a AS DOUBLE) / {scale})" for c in "gh")
                total = (f"{gl} * {gl} / ({hl} + {one}) + ({ga} - {gl}) * ({ga} - {gl}) / ({ha} - {hl} + {one}) - {ga} * {ga} / ({ha} + {one})")
                return (f"CASE WHEN bin >= 0 AND {node} >= {1 << d} AND {hl} >= {D(child)} AND {ha} - {hl} >= {D(child)} AND {total} > {D(1e-6)} "
                        f"AND {total} >= {D(gamma)} THEN {total} END")

            parts.append(f"""a{k} AS (SELECT *, sum(g) OVER p AS ga, sum(h) OVER p AS ha,
  sum(CASE WHEN bin < 0 THEN g ELSE 0 END) OVER p AS gm, sum(CASE WHEN bin < 0 THEN h ELSE 0 END) OVER p AS hm,
  sum(CASE WHEN bin >= 0 THEN g ELSE 0 END) OVER s AS gs, sum(CASE WHEN bin >= 0 THEN h ELSE 0 END) OVER s AS hs
  FROM r{k} WINDOW p AS (PARTITION BY {node}, f), s AS (PARTITION BY {node}, f ORDER BY bin)),
b{k} AS (SELECT *, {gain('left')} AS q0, {gain('')} AS q1 FROM a{k}),
c{k} AS (SELECT * EXCLUDE (ga, gm, hm, gs, hs, q0, q1), CASE WHEN q0 IS NULL THEN q1 WHEN q1 IS NULL OR q0 >= q1 THEN q0 ELSE q1 END AS q,
  CASE WHEN q0 IS NOT NULL AND (q1 IS NULL OR q0 >= q1) THEN 0 ELSE 1 END AS side FROM b{k}),
d{k} AS (SELECT * EXCLUDE (q, side, ha), CAST(ha AS DOUBLE) / {scale} AS h{k}, first_value(q) OVER w AS q{k}, first_value(f) OVER w AS f{k},
  first_value(feature) OVER w AS t{k}, first_value(bin) OVER w AS b{k}, first_value(side) OVER w AS s{k}
  FROM c{k} WINDOW w AS (PARTITION BY {node} ORDER BY q DESC NULLS LAST, f, bin, side)),
r{r}_{d + 1} AS (SELECT *, CASE WHEN q{k} IS NULL THEN {node} ELSE 2 * {node} + max(CASE WHEN f = f{k} THEN
  CASE WHEN bin < 0 THEN s{k} WHEN bin <= b{k} THEN 0 ELSE 1 END END) OVER (PARTITION BY id) END AS n{r}_{d + 1} FROM d{k})""")
        k = f"{r}_{depth}"
        parts.append(f"""v{r} AS (SELECT * EXCLUDE (g, h), CAST(sum(g) OVER p AS DOUBLE) / {scale} AS lg{r}, CAST(sum(h) OVER p AS DOUBLE) / {scale} AS lh{r}
  FROM r{k} WINDOW p AS (PARTITION BY n{k}, f)),
e{r + 1} AS (SELECT *, -lg{r} / (lh{r} + {one}) * {D(step)} AS v{r}, m{r} + -lg{r} / (lh{r} + {one}) * {D(step)} AS m{r + 1} FROM v{r})""")
    items = [f"struct_pack(tree := {r}, node := n{r}_{d}, f := f{r}_{d}, feature := t{r}_{d}, bin := b{r}_{d}, missing_left := s{r}_{d} = 0, "
             f"gain := q{r}_{d}, cover := h{r}_{d}, value := CAST(NULL AS DOUBLE))" for r in range(rounds) for d in range(depth)]
    items += [f"struct_pack(tree := {r}, node := n{r}_{depth}, f := CAST(NULL AS INTEGER), feature := CAST(NULL AS VARCHAR), "
              f"bin := CAST(NULL AS BIGINT), missing_left := CAST(NULL AS BOOLEAN), gain := CAST(NULL AS DOUBLE), cover := lh{r}, value := v{r})"
              for r in range(rounds)]
    parts.append(f"""seen AS (SELECT DISTINCT u.tree AS tree, u.node AS node, u.f AS f, u.feature AS feature, u.bin AS bin, u.missing_left AS missing_left,
  u.gain AS gain, u.cover AS cover, u.value AS value FROM (SELECT unnest([{', '.join(items)}]) AS u FROM e{rounds} WHERE f = 0)
  WHERE u.gain IS NOT NULL OR u.value IS NOT NULL),
nodes AS (SELECT seen.*, CASE WHEN bin = len(c) THEN 1.7976931348623157e308 ELSE c[bin + 1] END AS threshold FROM seen LEFT JOIN cuts USING (f))""")
    return ",\n".join(parts)


def boosted_sql() -> dict[str, str]:
    base = f"{BASE},\n{closed_cte('b')},\n{boosted_ctes()}\n"
    loss = ", ".join(f"avg(greatest(CASE WHEN y = 1 THEN -m{r} ELSE m{r} END, 0) + ln(1 + exp(-abs(m{r})))) AS l{r}" for r in (1, 2))
    names = ", ".join(f"('{f}')" for f in ("rate", "stay_nights", "total_guests", "required_car_parking_spaces", "special_requests",
                                           "lead_time", "total_rooms", "avg_review", "parking", "restaurant", "pool_and_spa"))
    return {
        "boosted_nodes": base + "SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, feature, threshold, missing_left, "
                                "round(gain, 9) AS gain, round(cover, 9) AS cover, round(value, 12) AS value FROM nodes",
        "boosted_loss_curve": base + f", loss AS (SELECT {loss} FROM e2 WHERE f = 0 AND is_test = 1) "
                                     "SELECT CAST(u.i AS INTEGER) AS round, round(u.l, 9) AS log_loss, CAST(u.b AS INTEGER) AS best_round FROM (SELECT unnest(["
                                     "struct_pack(i := 0, l := l1, b := 0), struct_pack(i := 1, l := l2, b := CASE WHEN l2 < l1 THEN 1 ELSE 0 END)]) AS u FROM loss)",
        "boosted_scores": base + "SELECT id AS booking_id, CAST(is_test AS INTEGER) AS is_test, "
                                 "round(CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + exp(-m2)), 12) AS score FROM e2 WHERE f = 0",
        "boosted_importance": base + f"SELECT name AS feature, CAST(count(feature) AS BIGINT) AS importance FROM (VALUES {names}) v(name) "
                                     "LEFT JOIN nodes ON feature = name GROUP BY name"}


def oracle_sql() -> dict[str, str]:
    return {k: _bigint_counts(v) for k, v in (_oracle_sql() | boosted_sql()).items()}


def _oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bookings_with_hotels"] = f"""{BASE}
SELECT booking_id, hotel_id,
       CASE WHEN reservation_status = 'No-Show' THEN 'Check-Out' ELSE reservation_status END AS reservation_status,
       CAST(booking_date AS VARCHAR) AS booking_date, CAST(arrival_date AS VARCHAR) AS arrival_date,
       rate, stay_nights, total_guests, coalesce(required_car_parking_spaces, 0) AS required_car_parking_spaces,
       coalesce(special_requests, 0) AS special_requests, board, country_x, hotel_type, country_y, parking,
       total_rooms, restaurant, pool_and_spa, avg_review
FROM merged"""
    q["filter_closed_bookings"] = f"""{BASE}
SELECT count(*) AS total_bookings,
       count_if(reservation_status IS DISTINCT FROM 'Booked') AS kept_keep_null_status,
       count_if(reservation_status <> 'Booked') AS kept_drop_null_status,
       count_if(reservation_status IS NULL) AS null_status,
       count_if(reservation_status = 'Booked') AS booked
FROM merged"""
    q["late_cancellation_target"] = f"""{BASE},
{closed_cte('a', 'ca')},
{closed_cte('b', 'cb')},
{closed_cte('c', 'cc')},
u AS (SELECT 'a' AS policy, target FROM ca UNION ALL SELECT 'b', target FROM cb UNION ALL SELECT 'c', target FROM cc)
SELECT policy, target, count(*) AS bookings,
       {pct('count(*)', 'sum(count(*)) OVER (PARTITION BY policy)')} AS share_pct
FROM u GROUP BY policy, target"""
    q["calendar_features"] = f"""{BASE}
SELECT booking_id,
       CAST(month(booking_date) AS INTEGER) AS booking_month,
       CAST(isodow(booking_date) - 1 AS INTEGER) AS booking_day_of_week,
       {flag('isodow(booking_date) - 1 IN (5, 6)')} AS booking_weekend,
       CAST(month(arrival_date) AS INTEGER) AS arrival_month,
       CAST(isodow(arrival_date) - 1 AS INTEGER) AS arrival_day_of_week,
       {flag('isodow(arrival_date) - 1 IN (4, 5)')} AS is_weekend_arrival,
       {flag('month(arrival_date) IN (6, 7, 8, 12)')} AS is_high_season,
       {flag('month(arrival_date) IN (6, 7, 8)')} AS is_summer,
       {flag('month(arrival_date) IN (12, 1, 2)')} AS is_winter
FROM merged"""
    lead = "date_diff('day', booking_date, arrival_date)"
    q["lead_and_stay_bands"] = f"""{BASE}
SELECT {_band(lead, K.LEAD_TIME_EDGES, K.LEAD_TIME_LABELS)} AS lead_time_category,
       {_band('stay_nights', K.STAY_EDGES, K.STAY_LABELS)} AS stay_duration_category,
       count(*) AS bookings
FROM merged GROUP BY ALL"""
    pr = ["very_low", "low", "medium", "high", "very_high"]
    arms = " ".join(f"WHEN ppn {'>=' if i == 0 else '>'} e[{i + 1}] AND ppn <= e[{i + 2}] THEN '{lab}'"
                    for i, lab in enumerate(pr))
    q["price_quintiles"] = f"""{BASE},
p0 AS (SELECT booking_id, CASE WHEN stay_nights IS NULL THEN NULL ELSE rate / greatest(stay_nights, {D(1.0)}) END AS ppn FROM merged),
e AS (SELECT quantile_cont(ppn, {lst([0.0, 0.2, 0.4, 0.6, 0.8, 1.0])}) AS e FROM p0)
SELECT booking_id, round(coalesce(ppn, (SELECT median(ppn) FROM p0)), 8) AS price_per_night,
       CASE {arms} END AS price_category FROM p0, e"""
    q["guest_flags"] = f"""{BASE}
SELECT booking_id, {flag('special_requests > 0')} AS has_special_requests,
       {flag('required_car_parking_spaces > 0')} AS requested_parking,
       {IS_FOREIGN} AS is_foreign,
       coalesce(CAST(pool_and_spa AS INTEGER), 0) + coalesce(CAST(restaurant AS INTEGER), 0)
         + coalesce(CAST(parking AS INTEGER), 0) AS num_assets
FROM merged"""
    q["continent_lookup"] = f"""{BASE}
SELECT country_x, {case_map('country_x', K.CONTINENT_MAP_TRAINING, K.UNKNOWN_CONTINENT)} AS continent_customer,
       country_y, {case_map('country_y', K.CONTINENT_MAP_SCORING, K.UNKNOWN_CONTINENT)} AS continent_hotel,
       count(*) AS bookings
FROM merged GROUP BY ALL"""
    q["iqr_capping"] = _cap_sql("iqr")
    q["quantile_capping"] = _cap_sql("quantile")
    q["outlier_counts"] = _outlier_counts_sql()
    q["impute_mean_median_mode"] = f"""{BASE}
SELECT booking_id,
       coalesce(rate, {mean_exact('rate', 'merged')}) AS rate,
       coalesce(special_requests, {mean_exact('special_requests', 'merged')}) AS special_requests,
       round(coalesce(total_guests, (SELECT median(total_guests) FROM merged)), 6) AS total_guests,
       round(coalesce(stay_nights, (SELECT median(stay_nights) FROM merged)), 6) AS stay_nights,
       coalesce(board, {mode_sql('board')}) AS board,
       coalesce(country_x, {mode_sql('country_x')}) AS country_x,
       coalesce(reservation_status, 'missing') AS reservation_status
FROM merged"""
    sc = []
    for c in ["rate", "stay_nights", "avg_review"]:
        sd = f"(SELECT stddev_pop({c}) FROM merged)"
        sc.append(f"round(CASE WHEN {sd} = 0 THEN {D(0.0)} ELSE ({c} - (SELECT avg({c}) FROM merged)) / {sd} END, 6) AS {c}")
    q["standard_scaling"] = f"{BASE}\nSELECT booking_id, {', '.join(sc)} FROM merged"
    q["one_hot_board"] = f"""{BASE}
SELECT booking_id, {', '.join(f"CAST(coalesce(board = '{v}', false) AS INTEGER) AS board_{v}" for v in ['BB', 'FB', 'HB', 'SC'])}
FROM merged"""
    q["gift_imputation"] = f"""{BASE},
{imputed_cte('merged', 'imp')}
SELECT booking_id, stay_nights, total_guests, rate, board, required_car_parking_spaces,
       special_requests, reservation_status, country_x, hotel_type, country_y,
       parking, total_rooms, restaurant, pool_and_spa, avg_review,
       CAST(arrival_date AS VARCHAR) AS arrival_date
FROM imp"""
    rank = f"row_number() OVER (PARTITION BY target ORDER BY {H('booking_id')}, booking_id)"
    q["stratified_split"] = f"""{BASE},
{closed_cte('b')},
r AS (SELECT booking_id, target, {rank} AS rn, count(*) OVER (PARTITION BY target) AS n FROM closed)
SELECT booking_id, target, CAST(CASE WHEN rn <= round(CAST(n AS DOUBLE) * {D(K.TEST_FRACTION)}) THEN 1 ELSE 0 END AS INTEGER) AS is_test
FROM r"""
    q["stratified_folds"] = f"""{BASE},
{closed_cte('b')},
r AS (SELECT booking_id, target, {rank} AS rn, count(*) OVER (PARTITION BY target) AS n FROM closed)
SELECT booking_id, target, CAST(((rn - 1) * 3) // n AS INTEGER) AS fold FROM r"""
    q["group_folds"] = f"""{BASE},
{closed_cte('b')},
{_group_folds_cte('closed')}
SELECT c.hotel_id, c.booking_id, c.target, gf.fold FROM closed c LEFT JOIN gf ON c.hotel_id = gf.hotel_id"""
    q["group_folds_even"] = f"""{BASE.replace("WITH ", "WITH RECURSIVE ", 1)},
{closed_cte('b')},
{_even_folds_cte('closed')}
SELECT c.hotel_id, c.booking_id, c.target, gf.fold FROM closed c LEFT JOIN gf ON c.hotel_id IS NOT DISTINCT FROM gf.hotel_id"""
    q["class_weights"] = f"""{BASE},
{closed_cte('b')}
SELECT booking_id, target, CASE WHEN target = 1 THEN {D(K.POSITIVE_CLASS_WEIGHT)} ELSE {D(1.0)} END AS weight FROM closed"""
    q["scorecard_probability"] = f"""{BASE_SCORED}
SELECT booking_id, label, score, CAST(score >= {D(THR)} AS INTEGER) AS prediction FROM scored"""
    q["fbeta_threshold"] = f"{BASE_SCORED},\n{_fbeta_sql(1.0)}"
    q["fbeta_threshold_half"] = f"{BASE_SCORED},\n{_fbeta_sql(0.5)}"
    exact = "(SELECT * REPLACE (score + CAST(booking_id AS DOUBLE) / CAST(3e9 AS DOUBLE) AS score) FROM scored)"
    q["fbeta_threshold_exact"] = f"""{BASE_SCORED},
x AS {exact},
{_curve('x')},
b AS (SELECT s, 2.0 * tp / (tp + fp + P) AS fb, tp, tp + fp AS flagged FROM c ORDER BY 2 DESC, 1 LIMIT 1)
SELECT true AS is_a_score, CAST(tp AS BIGINT) AS tp, CAST(flagged AS BIGINT) AS flagged, round(fb, 9) AS fbeta,
       round(fb, 9) AS fbeta_applied FROM b"""
    q["fold_thresholds"] = f"""{BASE_SCORED},
{_group_folds_cte('scored', 'label')},
sf AS (SELECT s.*, gf.fold FROM scored s LEFT JOIN gf ON s.hotel_id = gf.hotel_id),
{_fbeta_sql(1.0, 'fold', 'sf')}"""
    grid = arange(K.GRID_START, K.GRID_STOP, K.GRID_STEP)
    q["threshold_grid"] = f"""{BASE_SCORED},
{_grid_table(grid)}
SELECT round(coalesce((SELECT threshold FROM m WHERE f1 > 0 ORDER BY f1 DESC, i ASC LIMIT 1), {D(0.5)}), 6) AS best_threshold,
       round(coalesce((SELECT max(f1) FROM m WHERE f1 > 0), {D(0.0)}), 6) AS best_f1"""
    sweep = linspace(K.SWEEP_START, K.SWEEP_STOP, K.SWEEP_NUM)
    q["threshold_sweep"] = f"""{BASE_SCORED},
{_grid_table(sweep)}
SELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1, round(precision, 6) AS precision,
       round(recall, 6) AS recall FROM m"""
    q["confusion_and_rates"] = f"""{BASE_SCORED},
cm AS (SELECT count_if(label = 0 AND score < {D(THR)}) AS tn, count_if(label = 0 AND score >= {D(THR)}) AS fp,
              count_if(label = 1 AND score < {D(THR)}) AS fn, count_if(label = 1 AND score >= {D(THR)}) AS tp FROM scored)
SELECT tn, fp, fn, tp, {_metric_cols()} FROM cm"""

    def r(n, d):
        return f"CASE WHEN ({d}) > 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) ELSE {D(0.0)} END"
    q["classification_report"] = f"""{BASE_SCORED},
cm AS (SELECT CAST(count_if(label = 0 AND score < {D(THR)}) AS DOUBLE) AS tn, CAST(count_if(label = 0 AND score >= {D(THR)}) AS DOUBLE) AS fp,
              CAST(count_if(label = 1 AND score < {D(THR)}) AS DOUBLE) AS fn, CAST(count_if(label = 1 AND score >= {D(THR)}) AS DOUBLE) AS tp FROM scored),
per AS (SELECT '0' AS class, {r('tn', 'tn + fn')} AS precision, {r('tn', 'tn + fp')} AS recall,
               {r('2.0 * tn', '2.0 * tn + fn + fp')} AS f1, tn + fp AS support FROM cm
        UNION ALL
        SELECT '1', {r('tp', 'tp + fp')}, {r('tp', 'tp + fn')}, {r('2.0 * tp', '2.0 * tp + fp + fn')}, tp + fn FROM cm),
allr AS (SELECT * FROM per
  UNION ALL SELECT 'accuracy', NULL, NULL, {r('tp + tn', 'tp + tn + fp + fn')}, tp + tn + fp + fn FROM cm
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per
  UNION ALL SELECT 'weighted avg', {r('sum(precision * support)', 'sum(support)')}, {r('sum(recall * support)', 'sum(support)')},
                   {r('sum(f1 * support)', 'sum(support)')}, sum(support) FROM per)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM allr"""
    q["roc_auc"] = f"""{BASE_SCORED},
{_curve('scored')}
SELECT round(CAST(sum(CAST(pos AS HUGEINT) * (N - fp) * 2 + CAST(pos AS HUGEINT) * neg) AS DOUBLE)
             / (({D(2.0)} * CAST(max(P) AS DOUBLE)) * CAST(max(N) AS DOUBLE)), 6) AS roc_auc FROM c"""
    q["pr_auc"] = f"""{BASE_SCORED},
{_curve('scored')},
t AS (SELECT CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(tp - pos AS DOUBLE) AS ptp,
             CAST(fp - neg AS DOUBLE) AS pfp, CAST(P AS DOUBLE) AS P FROM c)
SELECT round(sum(((CASE WHEN P > 0 THEN tp / P ELSE {D(0.0)} END) - (CASE WHEN P > 0 THEN ptp / P ELSE {D(0.0)} END))
             * ((tp / (tp + fp)) + (CASE WHEN ptp + pfp > 0 THEN ptp / (ptp + pfp) ELSE {D(1.0)} END)) / {D(2.0)}), 6) AS pr_auc
FROM t"""
    e = gift_exprs("as_coded")
    cands = []
    for g in "ABCD":
        cands.append(f"""SELECT booking_id, '{g}' AS gift, {e['succ'][g]} AS success_probability,
       {e['cost'][g]} AS gift_cost, {e['ev'][g]} AS expected_value,
       {e['ev_none']} AS ev_no_intervention, {e['ev'][g]} > {e['ev_none']} AS beats_no_gift
FROM imp WHERE {e['elig'][g]}""")
    q["gift_candidates"] = f"{BASE},\n{INFERENCE},\n{imputed_cte()}\n" + "\nUNION ALL\n".join(cands)
    dec_cols = """SELECT booking_id, cancellation_probability, predicted_to_cancel, gift, cost_of_selected_gift,
       final_ev_with_gift_decision, ev_no_intervention FROM decided"""
    q["gift_decisions"] = f"{base_decided('as_coded')}\n{dec_cols}"
    q["gift_decisions_intended"] = f"{base_decided('intended')}\n{dec_cols}"
    q["campaign_economics"] = f"""{base_decided()},
a AS (SELECT count(*) AS total_bookings, count_if(gift IS NOT NULL) AS gifts_offered,
             {sum_exact('ev_no_intervention')} AS revenue_no_campaign,
             {sum_exact('final_ev_with_gift_decision')} AS revenue_with_campaign,
             coalesce({sum_exact('CASE WHEN gift IS NOT NULL THEN cost_of_selected_gift END')}, {D(0.0)}) AS cost
      FROM decided)
SELECT total_bookings, gifts_offered, {pct('gifts_offered', 'total_bookings')} AS gifts_pct,
       round(revenue_no_campaign, 4) AS revenue_no_campaign, round(revenue_with_campaign, 4) AS revenue_with_campaign,
       round(cost, 4) AS total_gift_cost, round(revenue_with_campaign - revenue_no_campaign, 4) AS net_impact,
       CASE WHEN gifts_offered > 0 THEN round(cost / CAST(gifts_offered AS DOUBLE), 4) END AS avg_gift_cost,
       CASE WHEN gifts_offered > 0 THEN round(CASE WHEN cost > 0 THEN (revenue_with_campaign - revenue_no_campaign) / cost
            ELSE {D(0.0)} END, 6) END AS roi
FROM a"""
    names = " ".join(f"WHEN '{g}' THEN '{n}'" for g, n in K.GIFT_NAMES.items())
    q["gift_distribution"] = f"""{base_decided()},
per AS (SELECT gift, count(*) AS bookings, {sum_exact('cancellation_probability')} AS psum,
               {sum_exact('cost_of_selected_gift')} AS csum FROM decided GROUP BY gift)
SELECT gift, CASE WHEN gift IS NULL THEN '{K.NO_GIFT_NAME}' ELSE CASE gift {names} ELSE 'Null' END END AS gift_name,
       bookings, {pct('bookings', '(SELECT count(*) FROM decided)')} AS share_pct,
       CASE WHEN gift IS NOT NULL THEN round(psum / CAST(bookings AS DOUBLE), 6) END AS avg_probability,
       CASE WHEN gift IS NOT NULL THEN round(csum / CAST(bookings AS DOUBLE), 4) END AS avg_cost
FROM per"""
    q["prediction_stats"] = f"""{BASE},
{INFERENCE}
SELECT count(*) AS total_bookings, CAST(coalesce(sum(predicted_to_cancel), 0) AS BIGINT) AS predicted_cancellations,
       {pct('coalesce(sum(predicted_to_cancel), 0)', 'count(*)')} AS predicted_pct FROM inf2"""
    q["gift_coverage"] = f"""{base_decided()},
a AS (SELECT CAST(coalesce(sum(predicted_to_cancel), 0) AS BIGINT) AS predicted_cancellations,
             count_if(gift IS NOT NULL) AS gifts_assigned FROM decided)
SELECT predicted_cancellations, gifts_assigned,
       CASE WHEN predicted_cancellations > 0 THEN {pct('gifts_assigned', 'predicted_cancellations')} END AS coverage_pct
FROM a"""
    lows = [THR] + K.SEGMENT_UPPER_BOUNDS[:-1]
    segs = list(zip(lows, K.SEGMENT_UPPER_BOUNDS))
    band = "CASE " + " ".join(
        f"WHEN cancellation_probability >= {D(float(lo))} AND cancellation_probability < {D(float(hi))} THEN {i}"
        for i, (lo, hi) in enumerate(segs)) + " END"
    bl = "CASE segment " + " ".join(f"WHEN {i} THEN {D(float(lo))}" for i, (lo, hi) in enumerate(segs)) + " END"
    bh = "CASE segment " + " ".join(f"WHEN {i} THEN {D(float(hi))}" for i, (lo, hi) in enumerate(segs)) + " END"
    q["probability_segments"] = f"""{base_decided()},
s AS (SELECT CAST({band} AS INTEGER) AS segment, CAST(gift IS NOT NULL AS INTEGER) AS g FROM decided)
SELECT segment, {bl} AS prob_low, {bh} AS prob_high, count(*) AS bookings, CAST(sum(g) AS BIGINT) AS gifts,
       {pct('sum(g)', 'count(*)')} AS gift_pct
FROM s WHERE segment IS NOT NULL AND (SELECT max(predicted_to_cancel) FROM decided) = 1 GROUP BY segment"""
    q["booked_vs_history"] = f"""{BASE},
{INFERENCE},
h AS (SELECT *, CASE WHEN reservation_status = 'Booked' THEN 'booked' ELSE 'history' END AS cohort,
             {flag("reservation_status = 'Canceled' AND date_diff('day', reservation_status_date, arrival_date) <= 30")} AS target
      FROM inf2),
g AS (SELECT cohort, count(*) AS bookings, CAST(sum(predicted_to_cancel) AS BIGINT) AS predicted_cancellations,
             CAST(sum(CASE WHEN cohort = 'history' THEN target END) AS BIGINT) AS actual_cancellations,
             {sum_exact('cancellation_probability')} AS psum FROM h GROUP BY cohort)
SELECT cohort, bookings, predicted_cancellations,
       round(CAST(predicted_cancellations AS DOUBLE) / CAST(bookings AS DOUBLE), 6) AS predicted_rate,
       actual_cancellations, round(CAST(actual_cancellations AS DOUBLE) / CAST(bookings AS DOUBLE), 6) AS actual_rate,
       round(psum / CAST(bookings AS DOUBLE), 6) AS avg_probability FROM g"""
    q["predictions_export"] = f"""{base_decided()}
SELECT booking_id, predicted_to_cancel AS prediction,
       CAST(CAST(round(CAST(cancellation_probability AS DECIMAL(20,6)), 4) AS DECIMAL(20,4)) AS VARCHAR) AS probability,
       coalesce(gift, '') AS gift FROM decided"""
    q.update(_neighbour_sql())
    return q


def _neighbour_sql() -> dict[str, str]:
    q = {}
    emb = "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings"
    dist = "sqrt(list_sum(list_transform(list_zip(a.vec, b.vec), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))"
    q["nearest_neighbors"] = f"""WITH e AS ({emb}),
p AS (SELECT a.id AS q_id, b.id AS n_id, {dist} AS dist FROM e a JOIN e b ON a.id <> b.id),
r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY dist, n_id) AS rank FROM p)
SELECT q_id, n_id, round(dist, 9) AS dist, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= {K.KNN_NEIGHBORS}"""
    q["tomek_links"] = f"""WITH e AS ({emb}),
p AS (SELECT a.id AS q_id, b.id AS n_id, {dist} AS dist FROM e a JOIN e b ON a.id <> b.id),
nn AS (SELECT q_id, n_id FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY dist, n_id) AS rk FROM p) WHERE rk = 1)
SELECT x.q_id AS a_id, x.n_id AS b_id, ea.label AS a_label, eb.label AS b_label
FROM nn x JOIN nn y ON x.q_id = y.n_id AND x.n_id = y.q_id
JOIN e ea ON ea.id = x.q_id JOIN e eb ON eb.id = x.n_id
WHERE x.q_id < x.n_id AND ea.label <> eb.label"""
    seed = K.SEED
    key = "CAST(m.id AS VARCHAR) || '|' || CAST(s.sample_no AS VARCHAR)"

    def smote(ratio: float) -> str:
        return f"""WITH e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec,
                  CAST(label = 0 AS INTEGER) AS label FROM embeddings),
cnt AS (SELECT label, count(*) AS n FROM e GROUP BY label),
mino AS (SELECT label, n FROM cnt ORDER BY n, label LIMIT 1),
maj AS (SELECT max(n) AS n FROM cnt WHERE label <> (SELECT label FROM mino)),
par AS (SELECT CAST(floor({D(ratio)} * CAST((SELECT n FROM maj) AS DOUBLE) - CAST((SELECT n FROM mino) AS DOUBLE)) AS BIGINT) AS n_new,
               (SELECT n FROM mino) AS n_min),
m AS (SELECT e.* FROM e WHERE label = (SELECT label FROM mino)),
pp AS (SELECT a.id AS q_id, b.id AS n_id, {dist} AS dist FROM m a JOIN m b ON a.id <> b.id),
nn AS (SELECT q_id, n_id, row_number() OVER (PARTITION BY q_id ORDER BY dist, n_id) AS rk FROM pp),
nn5 AS (SELECT * FROM nn WHERE rk <= {K.KNN_NEIGHBORS}),
ranked AS (SELECT id, row_number() OVER (ORDER BY {H('id', seed)}, id) - 1 AS i FROM m),
s AS (SELECT r.id, r.i + x.rr * par.n_min AS sample_no
      FROM ranked r, par, unnest(range(CAST(par.n_new // par.n_min + CASE WHEN r.i < par.n_new % par.n_min THEN 1 ELSE 0 END AS BIGINT))) AS x(rr)),
pick AS (SELECT m.id AS parent_id, s.sample_no, m.vec AS pv,
                {H(key, seed + 1)} % (SELECT count(*) FROM nn5 WHERE q_id = m.id) + 1 AS j,
                CAST({H(key, seed + 2)} AS DOUBLE) / CAST(1152921504606846976 AS DOUBLE) AS gap
         FROM s JOIN m ON s.id = m.id),
joined AS (SELECT pick.*, nn5.n_id AS neighbor_id, b.vec AS nv FROM pick
           JOIN nn5 ON nn5.q_id = pick.parent_id AND nn5.rk = pick.j JOIN m b ON b.id = nn5.n_id)"""

    q["smote_points"] = f"""{smote(K.SMOTE_RATIO)}
SELECT -(sample_no + 1) AS id, (SELECT label FROM mino) AS label, parent_id, neighbor_id, gap, sample_no,
       pv[1] + gap * (nv[1] - pv[1]) AS vec_first, pv[len(pv)] + gap * (nv[len(nv)] - pv[len(pv)]) AS vec_last
FROM joined"""
    q["smote_tomek_balance"] = f"""{smote(1.0)},
o AS (SELECT id, label, vec FROM e UNION ALL
      SELECT -(sample_no + 1), (SELECT label FROM mino),
             list_transform(list_zip(pv, nv), lambda z: z[1] + gap * (z[2] - z[1])) FROM joined),
op AS (SELECT a.id AS q_id, b.id AS n_id, {dist} AS dist FROM o a JOIN o b ON a.id <> b.id),
one AS (SELECT q_id, n_id FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY dist, n_id) AS rk FROM op) WHERE rk = 1),
ends AS (SELECT x.q_id FROM one x JOIN one y ON x.q_id = y.n_id AND x.n_id = y.q_id
         JOIN o oa ON oa.id = x.q_id JOIN o ob ON ob.id = x.n_id WHERE oa.label <> ob.label)
SELECT label, count(*) AS rows FROM o WHERE id NOT IN (SELECT q_id FROM ends) GROUP BY label"""
    cols = ["rate", "stay_nights", "total_guests", "lead_time"]
    n = len(cols)
    vlist = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in cols) + "]"
    any_null = " OR ".join(f"{c} IS NULL" for c in cols)
    terms = [f"CASE WHEN qv[{i + 1}] IS NOT NULL AND nv[{i + 1}] IS NOT NULL THEN (qv[{i + 1}] - nv[{i + 1}]) * (qv[{i + 1}] - nv[{i + 1}]) ELSE {D(0.0)} END" for i in range(n)]
    sq = terms[0]
    for t in terms[1:]:
        sq = f"({sq}) + ({t})"
    mcount = " + ".join(f"CASE WHEN qv[{i + 1}] IS NOT NULL AND nv[{i + 1}] IS NOT NULL THEN 1 ELSE 0 END" for i in range(n))
    fills, sel = [], []
    for i, c in enumerate(cols):
        fills.append(f"""f{i} AS (SELECT q_id, avg(nv[{i + 1}]) AS f FROM (
    SELECT q_id, nv, row_number() OVER (PARTITION BY q_id ORDER BY d2, n_id) AS rk FROM d
    WHERE qv[{i + 1}] IS NULL AND nv[{i + 1}] IS NOT NULL) WHERE rk <= {K.KNN_NEIGHBORS} GROUP BY q_id)""")
        sel.append(f"round(coalesce(x.v[{i + 1}], f{i}.f, (SELECT CAST(sum(CAST(v[{i + 1}] AS DECIMAL(38,12))) AS DOUBLE) / CAST(count(v[{i + 1}]) AS DOUBLE) FROM x)), 8) AS {c}")
    joins = " ".join(f"LEFT JOIN f{i} ON f{i}.q_id = x.id" for i in range(n))
    q["knn_impute"] = f"""{BASE},
{INFERENCE},
x AS (SELECT booking_id AS id, {vlist} AS v, ({any_null}) AS recv FROM inf2),
p AS (SELECT a.id AS q_id, b.id AS n_id, a.v AS qv, b.v AS nv FROM x a JOIN x b ON a.id <> b.id WHERE a.recv),
d AS (SELECT q_id, n_id, qv, nv, (CAST({n} AS DOUBLE) / CAST(({mcount}) AS DOUBLE)) * ({sq}) AS d2
      FROM p WHERE ({mcount}) > 0),
{",".join(fills)}
SELECT x.id AS booking_id, {", ".join(sel)} FROM x {joins}"""
    rank = f"row_number() OVER (PARTITION BY target ORDER BY {H('booking_id')}, booking_id)"
    unseen = [x.replace("FROM x)", "FROM x WHERE is_test = 0)") for x in sel]
    q["knn_impute_unseen"] = f"""{BASE},
{closed_cte('b')},
r AS (SELECT *, {rank} AS rn, count(*) OVER (PARTITION BY target) AS n FROM closed),
x AS (SELECT booking_id AS id, {vlist} AS v, ({any_null}) AS recv,
             CASE WHEN rn <= round(CAST(n AS DOUBLE) * {D(K.TEST_FRACTION)}) THEN 1 ELSE 0 END AS is_test FROM r),
p AS (SELECT a.id AS q_id, b.id AS n_id, a.v AS qv, b.v AS nv FROM x a JOIN x b ON a.is_test = 1 AND b.is_test = 0 WHERE a.recv),
d AS (SELECT q_id, n_id, qv, nv, (CAST({n} AS DOUBLE) / CAST(({mcount}) AS DOUBLE)) * ({sq}) AS d2
      FROM p WHERE ({mcount}) > 0),
{",".join(fills)}
SELECT x.id AS booking_id, {", ".join(unseen)} FROM x {joins} WHERE x.is_test = 1"""
    q["variance_filter"] = f"""WITH l AS (SELECT CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim,
                  CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
SELECT dim, round(var_pop(x), 8) AS variance, var_pop(x) >= {D(K.VARIANCE_THRESHOLD)} AS kept FROM l GROUP BY dim"""
    q["anova_f_topk"] = f"""WITH l AS (SELECT label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim,
                  CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
g AS (SELECT dim, label, count(*) AS n, sum(x) AS s, sum(x * x) AS ss FROM l GROUP BY dim, label),
d AS (SELECT dim, sum(n) AS N, count(*) AS k, sum(s) AS S, sum(ss) AS SS, sum(s * s / n) AS br FROM g GROUP BY dim),
f AS (SELECT dim, ((br - S * S / N) / (k - 1)) / ((SS - br) / (N - k)) AS f FROM d),
r AS (SELECT dim, f, row_number() OVER (ORDER BY f DESC NULLS LAST, dim) AS rank FROM f)
SELECT dim, round(f, 6) AS f_score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= {K.ANOVA_TOP_K}"""
    return q
