"""Hand-computed goldens, null-semantics traps and properties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from staysense.functions import constants as K
from staysense.functions.columns import clip, day_diff
from staysense.functions.grids import arange, linspace
from staysense.operators import gifts as G
from staysense.operators import metrics as M
from staysense.operators import prepare as P
from staysense.operators import split as SP
from staysense.operators.quantiles import exact_quantiles, modes
from conftest import SF_SMALL


def test_published_confusion_reproduces_published_rates(spark):
    # run 1 and run 2 confusion counts -> their published precision/recall/F1/...
    df = spark.createDataFrame([(34415, 4027, 3111, 5067), (34306, 4136, 3080, 5098)], "tn long, fp long, fn long, tp long")
    r1, r2 = df.select(*M.metrics_from_confusion()).collect()
    assert round(r1.precision, 4) == 0.5572 and round(r1.recall, 4) == 0.6196 and round(r1.f1, 4) == 0.5867
    assert round(r1.accuracy, 4) == 0.8469 and round(r1.specificity, 4) == 0.8952
    assert round(r1.false_alarm_rate, 4) == 0.1048 and round(r1.miss_rate, 4) == 0.3804
    assert round(r2.precision, 4) == 0.5521 and round(r2.recall, 4) == 0.6234 and round(r2.f1, 4) == 0.5856
    assert round(r2.accuracy, 4) == 0.8452 and round(r2.specificity, 4) == 0.8924


def test_grids_equal_numpy():
    assert arange(0.3, 0.7, 0.01) == list(np.arange(0.3, 0.7, 0.01))
    assert linspace(0.1, 0.8, 40) == list(np.linspace(0.1, 0.8, 40))


def test_day_diff_floors_and_clip_keeps_null(spark):
    df = spark.createDataFrame([("2024-01-02 00:00:00", "2024-01-02 12:00:00", None)],
                               "a string, b string, x double")
    df = df.select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"), "x")
    r = df.select(day_diff("a", "b").alias("d"), clip("x", 0.0, 1.0).alias("c")).first()
    assert r.d == -1 and r.c is None


def test_exact_quantiles_match_numpy_linear(spark):
    vals = [1.0, 2.0, 3.0, 10.0, 10.0, 10.0, 7.5, -4.0, 0.0, 2.0]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = exact_quantiles(df, "x", probs).first()[0]
    assert np.allclose(got, np.quantile(vals, probs), rtol=0, atol=1e-12)
    assert exact_quantiles(df.where("x > 100"), "x", [0.5]).first()[0] == [None]


def test_mode_ties_take_smallest(spark):
    df = spark.createDataFrame([("b", True), ("a", False), ("b", False), ("a", True), (None, None)], "s string, t boolean")
    r = modes(df, ["s", "t"]).first()
    assert r.s == "a" and r.t is False


def _gift_row(spark, **kw):
    base = dict(booking_id=1, cancellation_probability=0.9, rate=400.0, stay_nights=2, total_guests=2, board="SC",
                restaurant=True, total_rooms=100.0, parking=True, pool_and_spa=True, hotel_type="City Hotel",
                avg_review=4.5, arrival_date="2024-06-06 00:00:00")
    base.update(kw)
    schema = ("booking_id long, cancellation_probability double, rate double, stay_nights int, total_guests int, "
              "board string, restaurant boolean, total_rooms double, parking boolean, pool_and_spa boolean, "
              "hotel_type string, avg_review double, arrival_date string")
    df = spark.createDataFrame([tuple(base.values())], schema)
    return df.withColumn("arrival_date", F.col("arrival_date").cast("timestamp_ntz"))


# gift, cost and expected value worked out by hand: changes to the row above -> as coded, as intended
GIFTS = [
    ({}, ("B", 41.0, 264.185), ("B", 41.0, 309.68)),
    ({"cancellation_probability": 0.3}, (None, 0.0, 309.7), (None, 0.0, 317.8)),
    ({"board": "BB"}, ("B", 41.0, 264.185), ("B", 41.0, 309.68)),
    ({"total_rooms": 50.0}, ("D", 23.0, 255.095), ("D", 23.0, 266.03)),
    ({"hotel_type": "Resort Hotel", "parking": False}, ("B", 41.0, 264.185), ("D", 23.0, 295.73)),
    ({"rate": 40.0}, ("B", 8.6, 21.9185), ("B", 8.6, 26.468)),
    ({"stay_nights": 7, "total_guests": 4}, ("A", 117.0, 283.0), ("B", 41.0, 302.876)),
]


@pytest.mark.parametrize("match", [0, 1])
@pytest.mark.parametrize("row", GIFTS, ids=lambda r: ",".join(r[0]) or "base")
def test_gift_table(spark, match, row):
    out = G.decide_gifts(_gift_row(spark, **row[0]), 0.4912, params=G.GiftParams(
        hotel_type_match=("as_coded", "intended")[match])).first()
    gift, cost, ev = row[1 + match]
    assert out.gift == gift
    assert out.cost_of_selected_gift == pytest.approx(cost)
    assert out.final_ev_with_gift_decision == pytest.approx(ev)
    assert out.final_ev_with_gift_decision >= out.ev_no_intervention - 1e-9


def test_fbeta_threshold_empty_input(spark):
    df = spark.createDataFrame([], "label int, score double")
    r = M.fbeta_threshold(df, "label", "score").first()
    assert (r.threshold, r.fbeta) == (0.5, 0.0)


def test_auc_invariant_under_monotone_map(spark):
    rng = np.random.default_rng(0)
    rows = [(int(rng.random() < 0.3), float(round(rng.random(), 3))) for _ in range(400)]
    df = spark.createDataFrame(rows, "label int, score double")
    a = M.roc_auc(df, "label", "score").first()[0]
    b = M.roc_auc(df.withColumn("score", F.col("score") * 3 + 1), "label", "score").first()[0]
    y = np.array([r[0] for r in rows]); s = np.array([r[1] for r in rows])
    pos, neg = s[y == 1], s[y == 0]
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert a == b == round(brute, 6)


def test_group_folds_never_split_a_group(spark):
    from staysense.plans import catalog as C
    df = C.q_group_folds(spark, SF_SMALL)
    assert df.groupBy("hotel_id").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0


def test_stratified_split_share_per_class(spark):
    from staysense.plans import catalog as C
    df = C.q_stratified_split(spark, SF_SMALL)
    for r in df.groupBy("target").agg(F.count("*").alias("n"), F.sum("is_test").alias("t")).collect():
        assert abs(r.t - 0.2 * r.n) <= 1


def test_target_policies_differ_on_late_status(spark):
    df = spark.createDataFrame([("Canceled", -3), ("Canceled", 10), ("No-Show", 5), (None, 1)],
                               "reservation_status string, days_before_arrival int")
    got = {p: [r[0] for r in df.select(P.late_cancel_flag(p)).collect()] for p in "abc"}
    assert got == {"a": [0, 1, 0, 0], "b": [1, 1, 0, 0], "c": [1, 1, 1, 0]}


def test_price_quintiles_reject_duplicate_edges(spark):
    df = spark.createDataFrame([(1.0, 1.0)] * 10 + [(2.0, 1.0)], "rate double, stay_nights double")
    with pytest.raises(Exception, match="not unique"):
        P.price_features(df).collect()


def test_missing_price_has_no_band_and_gets_the_median(spark):
    df = spark.createDataFrame([(float(i), 1.0) for i in range(11)] + [(None, 2.0), (50.0, None)], "rate double, stay_nights double")
    rows = P.price_features(df).orderBy("rate").collect()
    assert [r.price_category for r in rows if r.rate is None or r.stay_nights is None] == [None, None]
    assert {r.price_per_night for r in rows if r.rate is None or r.stay_nights is None} == {5.0}
    assert all(r.price_category is not None for r in rows if r.rate is not None and r.stay_nights is not None)


def test_threshold_is_a_score_and_gives_its_fbeta(spark):
    df = spark.createDataFrame([(1, 0.7123457), (0, 0.2), (0, 0.71234565), (1, 0.9)], "label int, score double")
    r = M.fbeta_threshold(df, "label", "score").first()
    assert (r.threshold, r.fbeta) == (0.7123457, 1.0)


def test_probability_text_is_rounded_once(spark):
    from staysense.sources.io import predictions_frame
    df = spark.createDataFrame([(1, 1, 0.12344999996, None), (2, 0, 0.5, "A")],
                               "booking_id int, predicted_to_cancel int, cancellation_probability double, gift string")
    assert [tuple(r) for r in predictions_frame(df).collect()] == [(1, 1, "0.1234", ""), (2, 0, "0.5000", "A")]


def test_text_column_without_values_becomes_unknown(spark):
    from staysense.operators import stats as S
    df = spark.createDataFrame([(1, 2.0, 2.0, 9.0, "SC", None, None), (2, 1.0, 1.0, 5.0, None, None, None)],
                               "booking_id int, stay_nights double, total_guests double, rate double, board string, "
                               "hotel_type string, arrival_date timestamp_ntz")
    assert {r.hotel_type for r in S.impute_for_gifting(df, "2000-01-01 00:00:00").collect()} == {"Unknown"}


def test_group_folds_with_many_groups_and_no_broadcast(spark, monkeypatch):
    import staysense.functions.joins as J
    monkeypatch.setattr(J, "bounded_broadcast", lambda df, max_rows=0: df)
    df = spark.range(6000).selectExpr("id AS booking_id", "concat('h', id % 900) AS hotel_id", "CAST(id % 7 = 0 AS INT) AS label")
    out = SP.stratified_group_folds(df, "label", "hotel_id", 7)
    assert out.count() == 6000 and out.groupBy("hotel_id").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    per = [r.n for r in out.where("label = 1").groupBy("fold").agg(F.count("*").alias("n")).collect()]
    assert len(per) == 7 and max(per) - min(per) <= 14


def test_missing_columns_are_tolerated(spark):
    df = spark.createDataFrame([(1, "FRA")], "booking_id long, country_x string")
    out = P.guest_flags(P.map_continent(df, "country_y", "continent_hotel")).first()
    assert out.is_foreign == 0 and out.num_assets == 0 and out.continent_hotel == K.UNKNOWN_CONTINENT


@pytest.mark.parametrize("exclude_self", [True, False])
def test_knn_hot_vector_matches_brute_force(spark, exclude_self):
    """A third of the rows share one vector (a hot key); the rest sit on a coarse grid
    (more duplicates).  Exact top-k with ties by id must equal brute force."""
    import numpy as np
    from staysense.operators.neighbors import knn, knn_grouped
    rng = np.random.default_rng(7)
    n, k = 240, 5
    vecs = [[0.0, 0.0] if i % 3 == 0 else [float(rng.integers(0, 6)), float(rng.integers(0, 6))] for i in range(n)]
    df = spark.createDataFrame([(i, v, i % 2) for i, v in enumerate(vecs)], "id long, vec array<double>, g int")
    x = np.array(vecs)
    expect = set()
    for i in range(n):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = sorted((d[j], j) for j in range(n) if not (exclude_self and j == i))[:k]
        expect |= {(i, j, r + 1, round(float(dist), 9)) for r, (dist, j) in enumerate(order)}
    got = {(r.q_id, r.n_id, r.rank, round(r.dist, 9))
           for r in knn(df, df, k=k, exclude_self=exclude_self, n_cells=4).collect()}
    assert got == expect
    expect_g = set()
    for i in range(n):
        same = [j for j in range(n) if j % 2 == i % 2 and not (exclude_self and j == i)]
        d = {j: float(np.sqrt(((x[j] - x[i]) ** 2).sum())) for j in same}
        expect_g |= {(i, j, r + 1) for r, j in enumerate(sorted(same, key=lambda j: (d[j], j))[:k])}
    got_g = {(r.q_id, r.n_id, r.rank)
             for r in knn_grouped(df, df, k, group="g", exclude_self=exclude_self, rows_per_cell=20).collect()}
    assert got_g == expect_g


def test_knn_impute_with_many_missing_patterns(spark):
    """Six columns, every pattern of missing values: against brute force."""
    from staysense.operators.impute_knn import knn_impute
    rng = np.random.default_rng(1)
    n, c, k = 160, 6, 3
    v = rng.normal(size=(n, c)).round(3)
    miss = np.array([[(i >> j) & 1 for j in range(c)] for i in range(n)], bool)
    miss[60:, :] = rng.random((n - 60, c)) < 0.4
    v[miss] = np.nan
    rows = [(i, *[None if np.isnan(x) else float(x) for x in v[i]]) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"c{j} double" for j in range(c)))
    got = {r.id: r for r in knn_impute(df, [f"c{j}" for j in range(c)], "id", k).collect()}
    for i in range(n):
        both = ~np.isnan(v) & ~np.isnan(v[i])
        m = both.sum(axis=1)
        d = np.where(m > 0, c / np.maximum(m, 1) * (np.where(both, v - v[i], 0) ** 2).sum(axis=1), np.inf)
        d[i] = np.inf
        for j in range(c):
            want = v[i, j]
            if np.isnan(want):
                donors = [x for x in sorted(range(n), key=lambda x: (d[x], x)) if np.isfinite(d[x]) and not np.isnan(v[x, j])][:k]
                want = v[donors, j].mean() if donors else np.nanmean(v[:, j])
            assert getattr(got[i], f"c{j}") == pytest.approx(want, abs=1e-9), (i, j)


def brute_fill(train, new, k):
    """(train, new): float arrays with NaN; the filled copy of ``new``, ties to the earlier training row."""
    out = new.copy()
    for i, row in enumerate(new):
        both = ~np.isnan(train) & ~np.isnan(row)
        m = both.sum(axis=1)
        d = np.where(m > 0, train.shape[1] / np.maximum(m, 1) * (np.where(both, train - row, 0) ** 2).sum(axis=1), np.inf)
        for j in np.flatnonzero(np.isnan(row)):
            donors = [x for x in np.argsort(d, kind="stable") if np.isfinite(d[x]) and not np.isnan(train[x, j])][:k]
            known = train[~np.isnan(train[:, j]), j]
            out[i, j] = train[donors, j].mean() if donors else known.mean() if len(known) else np.nan
    return out


def test_knn_imputer_fitted_saved_and_applied_to_new_rows(spark, tmp_path):
    """New rows share ids with training rows; some have no value at all, one column has a training value only now and then."""
    from staysense.operators.impute_knn import KnnImputer
    rng = np.random.default_rng(7)
    train, new = rng.normal(size=(120, 4)).round(1), rng.normal(size=(60, 4)).round(1)
    train[rng.random(train.shape) < 0.3] = np.nan
    train[:110, 3] = np.nan
    new[rng.random(new.shape) < 0.4] = np.nan
    new[:3] = np.nan

    def frame(v):
        return spark.createDataFrame([(i, "x", *[None if np.isnan(c) else float(c) for c in r]) for i, r in enumerate(v)],
                                     "id int, other string, a double, b double, c double, d double")

    KnnImputer.fit(frame(train), ["a", "b", "c", "d"], "id", 3).save(str(tmp_path / "imputer"))
    rows = KnnImputer.load(spark, str(tmp_path / "imputer")).transform(frame(new), "id").orderBy("id").collect()
    assert [r.other for r in rows] == ["x"] * 60
    assert np.allclose([[r.a, r.b, r.c, r.d] for r in rows], brute_fill(train, new, 3), atol=1e-9)


def test_knn_imputer_without_training_rows(spark):
    from staysense.operators.impute_knn import KnnImputer
    rows = spark.createDataFrame([(1, 2.0, None), (2, None, None)], "id int, a double, b double")
    model = KnnImputer.fit(rows.limit(0), ["a", "b"], "id")
    assert sorted(tuple(r) for r in model.transform(rows, "id").select("id", "a", "b").collect()) == [(1, 2.0, None), (2, None, None)]
    assert model.transform(rows.limit(0), "id").count() == 0


@pytest.mark.parametrize("batch", [2048, 16])
def test_least_deviation_group_folds(spark, batch):
    """Against plain Python, in one batch and in several; three classes, a null group, a hot group, unknown labels."""
    import hashlib
    from staysense.operators.split import least_deviation_group_folds
    rng = np.random.default_rng(3)
    rows = [(i, None if g == 0 else f"g{g}", int(y)) for i, (g, y) in enumerate(zip(
        np.where(rng.random(1500) < 0.3, 5, rng.integers(0, 50, 1500)), rng.choice([0, 1, 2, 9], 1500, p=[.6, .2, .15, .05])))]
    df = spark.createDataFrame(rows, "id int, g string, y int")
    k, classes = 4, [0, 1, 2]
    got = least_deviation_group_folds(df, "y", "g", classes, k, batch=batch).collect()
    assert sorted((r.id, r.g, r.y) for r in got) == sorted(rows, key=lambda r: r[0])
    counts = {}
    for _, g, y in rows:
        counts.setdefault(g, [0, 0, 0])
        if y in classes:
            counts[g][classes.index(y)] += 1
    hashes = {r.g: r.h for r in df.select("g").distinct().selectExpr(
        "g", "CAST(conv(substr(md5(concat(g, '|42')), 1, 15), 16, 10) AS BIGINT) AS h").collect()}
    spread = {g: 3 * sum(x * x for x in c) - sum(c) ** 2 for g, c in counts.items()}
    order = sorted(counts, key=lambda g: (-spread[g], hashes[g] is not None, hashes[g] or 0, g or ""))
    want = {}
    for b in range(0, len(order), batch):
        part = order[b:b + batch]
        total = np.sum([counts[g] for g in part], axis=0)
        held = np.zeros((k, 3))
        for g in part:
            def left(f):
                after = held.copy()
                after[f] += counts[g]
                dev = sum(np.sqrt(max(k * (after[:, i] ** 2).sum() - after[:, i].sum() ** 2, 0)) / total[i]
                          for i in range(3) if total[i])
                return int(np.floor(dev * 1e9)), held[f].sum(), f
            pick = min(map(left, range(k)))[2]
            held[pick] += counts[g]
            want[g] = (pick + b // batch) % k
    assert {r.g: r.fold for r in got} == want


def test_least_deviation_folds_of_no_rows(spark):
    from staysense.operators.split import least_deviation_group_folds
    assert least_deviation_group_folds(spark.createDataFrame([], "g string, y int"), "y", "g").collect() == []


def test_block_nearest_keeps_only_what_can_be_nearest():
    """Of a block's candidates, the kk nearest within the bound, ties by id, distances to the last bit."""
    import numpy as np
    from staysense.operators import neighbors as N
    rnd = np.random.default_rng(3)
    cv = rnd.integers(0, 4, (300, 3)).astype("float64") + 1e6            # many ties, and far from zero
    qv, ids = cv[:40] + 0.25, rnd.permutation(300)
    for bound in (np.inf, 1.0):
        row, col, d = N._block_nearest(qv, np.full(40, bound), cv, ids, 4)
        want = []
        for i, q in enumerate(qv):
            dist = np.sqrt(((q - cv) ** 2).sum(axis=1))
            want += [(i, ids[j], dist[j]) for j in np.lexsort((ids, dist))[:4] if dist[j] <= bound]
        assert list(zip(row, ids[col], d)) == want


def test_search_results_carry_no_vectors_and_masked_rows_do_not_move_by_pattern(spark):
    """Found neighbours name their query by key; donors of one pattern do not all meet in one task."""
    from staysense.operators import neighbors as N
    from staysense.operators.impute_knn import KnnImputer
    df = spark.range(60_000).selectExpr("id", "CAST(id % 7 AS DOUBLE) AS a", "CASE WHEN id % 1000 <> 0 THEN id / 3.0D END AS b")
    vec = df.limit(50).selectExpr("id AS _qk", "array(a) AS q_vec", "1 AS _cell", "CAST('Infinity' AS DOUBLE) AS _r")
    cand = spark.range(50).selectExpr("id AS n_id", "array(CAST(id AS DOUBLE)) AS n_vec", "1 AS _cell")
    assert N._topk_in_cells(vec, cand, [], 2).columns == ["_qk", "n_id", "dist"]
    model = KnnImputer.fit(df.coalesce(1), ["a", "b"], "id", 3)
    gaps = df.where("b IS NULL").selectExpr("id", "array(a, b) AS v", "1 AS p")
    seen = {}

    def spy(queries, candidates, *args, **kw):
        seen["rows"] = [n for n in candidates.rdd.mapPartitions(lambda x: [sum(1 for _ in x)]).collect()]
        return spark.createDataFrame([], "q_id long, n_id long")

    from staysense.operators import impute_knn as I
    old, I.knn_grouped = I.knn_grouped, spy
    try:
        model._nearest(gaps)
    finally:
        I.knn_grouped = old
    assert sum(seen["rows"]) == 59_940 and max(seen["rows"]) < 50_000
