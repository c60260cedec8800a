"""Retention-gift optimiser (G1-G8) as pure Column expressions.

The reference evaluates it row by row in Python; here each quantity is a SQL
expression (built as text, parsed once on the JVM), the best gift is a
``greatest`` plus a first-match ``CASE`` (strictly better than doing nothing,
earlier gift wins ties), and the whole thing is a few flat projections inside
whole-stage codegen: no UDF, no shuffle.

``hotel_type_match``: ``'as_coded'`` reproduces the shipped behaviour, where
the hotel type is lower-cased before being compared with a capitalised name so
the city/resort branches never fire; ``'intended'`` compares case-insensitively.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staysense.functions import constants as K

GIFTS = ["A", "B", "C", "D"]


@dataclass(frozen=True)
class GiftParams:
    unit_costs: dict = field(default_factory=lambda: dict(K.GIFT_UNIT_COSTS))
    campaign_cost: float = K.CAMPAIGN_COST_PER_OFFER
    hotel_type_match: str = "as_coded"
    as_of: str = "2000-01-01 00:00:00"          # replaces "now" for a missing arrival date


def _d(x: float) -> str:
    """A DOUBLE literal in SQL text."""
    return f"{float(x)!r}D"


def _is_type_sql(name: str, p: GiftParams) -> str | None:
    """Hotel-type test; ``None`` when it is constant-false (the as-coded case)."""
    if p.hotel_type_match == "as_coded":
        return None
    if p.hotel_type_match == "intended":
        return f"coalesce(contains(lower(hotel_type), '{name.lower()}'), false)"
    raise ValueError(p.hotel_type_match)


def _pick(test: str | None, yes: float, no: float) -> str:
    return _d(no) if test is None else f"CASE WHEN {test} THEN {_d(yes)} ELSE {_d(no)} END"


# Every quantity below is built as SQL text and parsed once on the JVM: one driver
# round trip per column instead of one per Column operator.
def replacement_rate_sql(p: GiftParams = GiftParams()) -> str:
    """G1: chance a cancelled room is re-sold."""
    arrival = (f"coalesce(arrival_date, CAST('{p.as_of}' AS TIMESTAMP_NTZ) "
               f"+ make_dt_interval({K.ARRIVAL_FALLBACK_DAYS}))")
    lo, hi = K.REPLACEMENT_SHORT_STAY
    days = ", ".join(str(d) for d in K.REPLACEMENT_WEEKEND_DAYS)
    short_weekend = f"weekday({arrival}) IN ({days}) AND stay_nights >= {lo} AND stay_nights <= {hi}"
    time_factor = (f"CASE WHEN coalesce({short_weekend}, false) THEN {_d(K.TIME_FACTOR_SHORT_WEEKEND)} "
                   f"ELSE {_d(K.TIME_FACTOR_OTHER)} END")
    hotel_factor = _pick(_is_type_sql("City Hotel", p), K.HOTEL_FACTOR_CITY, K.HOTEL_FACTOR_OTHER)
    review_factor = f"least(1.0D, {_d(K.REVIEW_FACTOR_SCALE)} * avg_review)"    # least skips null -> 1.0
    return f"(({time_factor}) * {hotel_factor}) * {review_factor}"


def eligible_sql(g: str) -> str:
    """G2."""
    boards = ", ".join(f"'{b}'" for b in K.MEAL_BOARDS)
    return {"A": f"(NOT coalesce(board IN ({boards}), false) AND coalesce(restaurant, false))",
            "B": "coalesce(total_rooms > 80, false)",
            "C": "coalesce(parking, false)",
            "D": "coalesce(pool_and_spa, false)"}.get(g, "false")


def success_probability_sql(g: str, p: GiftParams = GiftParams()) -> str:
    """G3."""
    if g == "A":
        return f"least(1.0D, sqrt(total_guests * stay_nights) / {_d(K.SUCCESS_A_DIVISOR)})"
    if g == "B":
        return _pick(_is_type_sql("City Hotel", p), K.SUCCESS_B_CITY, K.SUCCESS_B_OTHER)
    if g == "C":
        return _d(K.SUCCESS_C)
    if g == "D":
        return _pick(_is_type_sql("Resort Hotel", p), K.SUCCESS_D_RESORT, K.SUCCESS_D_OTHER)
    return "0.0D"


def gift_cost_sql(g: str, p: GiftParams = GiftParams()) -> str:
    """G4 (campaign cost per offer included)."""
    c = p.unit_costs
    base = {"A": f"{_d(c['A'])} * total_guests * stay_nights" if "A" in c else None,
            "B": f"{_d(c['B'])} * rate" if "B" in c else None,
            "C": f"{_d(c['C'])} * stay_nights" if "C" in c else None,
            "D": f"{_d(c['D'])} * total_guests" if "D" in c else None}.get(g) or "0.0D"
    return f"({base}) + {_d(p.campaign_cost)}"


def ev_none_sql(prob: str, p: GiftParams = GiftParams()) -> str:
    """Expected value without any action."""
    return f"((1.0D - {prob}) * rate) + ({prob} * (rate * ({replacement_rate_sql(p)})))"


def gift_ev_sql(g: str, prob: str, p: GiftParams = GiftParams()) -> str:
    """Expected value when gift ``g`` is offered."""
    s = success_probability_sql(g, p)
    keep = f"((1.0D - {prob}) + ({prob} * ({s})))"
    still_cancel = f"({prob} * (1.0D - ({s})))"
    replaced = f"(rate * ({replacement_rate_sql(p)}))"
    return f"(({keep} * rate) + ({still_cancel} * {replaced})) - ({gift_cost_sql(g, p)})"


def replacement_rate(p: GiftParams = GiftParams()) -> Column:
    return F.expr(replacement_rate_sql(p))


def eligible(g: str) -> Column:
    return F.expr(eligible_sql(g))


def success_probability(g: str, p: GiftParams = GiftParams()) -> Column:
    return F.expr(success_probability_sql(g, p))


def gift_cost(g: str, p: GiftParams = GiftParams()) -> Column:
    return F.expr(gift_cost_sql(g, p))


def gift_ev(g: str, prob_col: str = "cancellation_probability", p: GiftParams = GiftParams()) -> Column:
    return F.expr(gift_ev_sql(g, f"`{prob_col}`", p))


#: What a gift decision assumes of a column that the frame does not have.
ABSENT = {"stay_nights": f"CAST({K.DEFAULT_NIGHTS} AS INT)", "total_guests": f"CAST({K.DEFAULT_GUESTS} AS INT)",
          "rate": f"CAST({K.DEFAULT_RATE} AS DOUBLE)", "board": f"'{K.DEFAULT_BOARD}'",
          "avg_review": f"CAST({K.DEFAULT_AVG_REVIEW} AS DOUBLE)", "hotel_type": "'unknown'", "restaurant": "false",
          "total_rooms": "0", "parking": "false", "pool_and_spa": "false", "arrival_date": "CAST(NULL AS TIMESTAMP_NTZ)"}


def complete(df: DataFrame) -> DataFrame:
    """the decision inputs that are absent, as their defaults."""
    return df.selectExpr("*", *[f"{v} AS {c}" for c, v in ABSENT.items() if c not in df.columns])


def decide_gifts(df: DataFrame, threshold: float | Column, prob_col: str = "cancellation_probability",
                 params: GiftParams = GiftParams()) -> DataFrame:
    """Adds ``gift`` (null = none), ``cost_of_selected_gift``,
    ``final_ev_with_gift_decision`` and ``ev_no_intervention``.

    The reference walks the gifts in order and switches only to a *strictly* better
    one.  The same choice without a fold: ``_m`` = best eligible EV (``greatest``
    skips the nulls of ineligible gifts); the gift is the first one, in order, whose
    EV equals ``_m`` and beats doing nothing.  Two flat projections, no struct chain."""
    prob = f"`{prob_col}`"
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    evs = [f"CASE WHEN {eligible_sql(g)} THEN {gift_ev_sql(g, prob, params)} END AS `_ev_{g}`" for g in GIFTS]
    costs = [f"{gift_cost_sql(g, params)} AS `_cost_{g}`" for g in GIFTS]
    out = complete(df).select("*", F.expr(ev_none_sql(prob, params)).alias("ev_no_intervention"), thr.alias("_thr"),
                    *[F.expr(e) for e in evs + costs])
    best = "greatest(" + ", ".join(f"`_ev_{g}`" for g in GIFTS) + ")"
    pick = " ".join(f"WHEN `_ev_{g}` > ev_no_intervention AND `_ev_{g}` = `_m` THEN '{g}'" for g in GIFTS)
    out = out.select("*", F.expr(best).alias("_m")).select("*", F.expr(f"CASE {pick} END").alias("_g"))
    cost_of = "CASE `_g` " + " ".join(f"WHEN '{g}' THEN `_cost_{g}`" for g in GIFTS) + " ELSE 0.0D END"
    risky = f"{prob} >= `_thr`"
    return out.select(
        *[F.col(f"`{c}`") for c in df.columns], "ev_no_intervention",
        F.expr(f"CASE WHEN {risky} THEN `_g` END").alias("gift"),
        F.expr(f"CASE WHEN {risky} THEN {cost_of} ELSE 0.0D END").alias("cost_of_selected_gift"),
        F.expr(f"CASE WHEN {risky} AND `_g` IS NOT NULL THEN `_m` ELSE ev_no_intervention END")
         .alias("final_ev_with_gift_decision"),
    )


def gift_candidates(df: DataFrame, key: str = "booking_id", prob_col: str = "cancellation_probability",
                    params: GiftParams = GiftParams()) -> DataFrame:
    """Long audit table, one row per (booking, eligible gift) with its EV and whether
    it beats doing nothing.  ``explode`` is a generator inside the same stage."""
    prob = f"`{prob_col}`"
    opts = ", ".join(
        f"named_struct('gift', '{g}', 'eligible', {eligible_sql(g)}, "
        f"'success_probability', {success_probability_sql(g, params)}, 'gift_cost', {gift_cost_sql(g, params)}, "
        f"'expected_value', {gift_ev_sql(g, prob, params)})" for g in GIFTS)
    out = complete(df).select(F.col(key), F.expr(ev_none_sql(prob, params)).alias("ev_no_intervention"),
                    F.expr(f"explode(array({opts}))").alias("o"))
    return (out.where("o.eligible")
               .selectExpr(key, "o.gift", "o.success_probability", "o.gift_cost", "o.expected_value",
                           "ev_no_intervention", "o.expected_value > ev_no_intervention AS beats_no_gift"))


def score_with_threshold(df: DataFrame, threshold: float | Column, prob_col: str = "cancellation_probability",
                         out: str = "predicted_to_cancel") -> DataFrame:
    """0/1 decision ``p >= threshold``."""
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return df.withColumn(out, (F.col(prob_col) >= thr).cast("int"))
