"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver tables through the fixture views, so its work
grows with the tables; nothing is sampled, capped or filtered by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staysense.functions import constants as K
from staysense.functions.columns import flag
from staysense.operators import gifts as G
from staysense.operators import metrics as M
from staysense.operators import prepare as P
from staysense.operators import report as R
from staysense.operators import split as SP
from staysense.operators import stats as S
from staysense.operators.scorecard import scorecard_probability
from staysense.plans import score as SC
from staysense.session import cut_lineage, dealt
from staysense.sources import fixtures as FX
from staysense.sources.io import predictions_frame

THRESHOLD = K.DEFAULT_FALLBACK_THRESHOLD
AS_OF = "2000-01-01 00:00:00"


def _ts(c: str):
    return F.col(c).cast("string").alias(c)


def _rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """For comparison only: operators return full precision."""
    return df.select(*[F.round(c, places).alias(c) if c in columns else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ base frames
def merged(spark: SparkSession, sf: str) -> DataFrame:
    return P.join_hotels(FX.bookings(spark, sf), FX.hotels(spark, sf))


def closed(spark: SparkSession, sf: str, policy: str = "b") -> DataFrame:
    return P.training_frame(FX.bookings(spark, sf), FX.hotels(spark, sf), policy)


def scored_closed(spark: SparkSession, sf: str) -> DataFrame:
    """Closed bookings (policy b) with the scorecard probability: the evaluation input."""
    return scorecard_probability(closed(spark, sf), out="score").withColumnRenamed("target", "label")


def inference(spark: SparkSession, sf: str) -> DataFrame:
    return SC.score_bookings(FX.bookings(spark, sf), FX.hotels(spark, sf), THRESHOLD)


def decided(spark: SparkSession, sf: str, match: str = "as_coded") -> DataFrame:
    return SC.decide(inference(spark, sf), THRESHOLD, G.GiftParams(hotel_type_match=match, as_of=AS_OF))


# --------------------------------------------------------------------- queries
def q_bookings_with_hotels(spark, sf):
    """S2, J1, X1, X5."""
    df = P.merge_no_show(P.zero_fill(merged(spark, sf)))
    return df.select("booking_id", "hotel_id", "reservation_status", _ts("booking_date"), _ts("arrival_date"),
                     "rate", "stay_nights", "total_guests", "required_car_parking_spaces", "special_requests",
                     "board", "country_x", "hotel_type", "country_y", "parking", "total_rooms", "restaurant",
                     "pool_and_spa", "avg_review")


def q_filter_closed_bookings(spark, sf):
    """what each filter keeps."""
    df = merged(spark, sf)
    s = F.col("reservation_status")
    return df.agg(F.count(F.lit(1)).alias("total_bookings"),
                  F.count_if(~s.eqNullSafe("Booked")).alias("kept_keep_null_status"),
                  F.count_if(s != "Booked").alias("kept_drop_null_status"),
                  F.count_if(s.isNull()).alias("null_status"),
                  F.count_if(s == "Booked").alias("booked"))


def q_late_cancellation_target(spark, sf):
    """Class balance of the three target policies.

    One scan: every row emits one (policy, kept?, target) entry per policy (policy a
    drops unknown status, b and c keep it; relabelling No-Show does not change a
    Canceled test), one partially aggregated groupBy, and the per-policy total is a
    window over the <= 6 aggregated rows."""
    df = P.add_day_diffs(P.parse_dates(merged(spark, sf)))
    s = F.col("reservation_status")
    keep_known, keep_all = F.coalesce(s != "Booked", F.lit(False)), ~s.eqNullSafe("Booked")
    opts = F.array(*[F.struct(F.lit(pol).alias("policy"), keep.alias("_keep"), P.late_cancel_flag(pol).alias("target"))
                     for pol, keep in (("a", keep_known), ("b", keep_all), ("c", keep_all))])
    g = (df.select(F.inline(opts)).where(F.col("_keep"))
           .groupBy("policy", "target").agg(F.count(F.lit(1)).alias("bookings")))
    total = F.sum("bookings").over(Window.partitionBy("policy"))
    return g.select("policy", "target", "bookings", F.round(F.col("bookings") * 100.0 / total, 4).alias("share_pct"))


def q_calendar_features(spark, sf):
    """X6-X9."""
    df = P.calendar_features(P.parse_dates(merged(spark, sf)))
    return df.select("booking_id", "booking_month", "booking_day_of_week", "booking_weekend", "arrival_month",
                     "arrival_day_of_week", "is_weekend_arrival", "is_high_season", "is_summer", "is_winter")


def q_lead_and_stay_bands(spark, sf):
    """Band counts (null band kept)."""
    df = P.band_features(P.add_day_diffs(P.parse_dates(merged(spark, sf))))
    return df.groupBy("lead_time_category", "stay_duration_category").agg(F.count(F.lit(1)).alias("bookings"))


def q_price_quintiles(spark, sf):
    """X12, X13, A1."""
    df = P.price_features(merged(spark, sf))
    return df.select("booking_id", F.round("price_per_night", 8).alias("price_per_night"), "price_category")


def q_guest_flags(spark, sf):
    """X14-X16."""
    df = P.guest_flags(merged(spark, sf))
    return df.select("booking_id", "has_special_requests", "requested_parking", "is_foreign", "num_assets")


def q_continent_lookup(spark, sf):
    """J2 (training mapping for guests, scoring mapping for hotels)."""
    df = P.map_continent(merged(spark, sf), "country_x", "continent_customer", K.CONTINENT_MAP_TRAINING)
    df = P.map_continent(df, "country_y", "continent_hotel", K.CONTINENT_MAP_SCORING)
    return df.groupBy("country_x", "continent_customer", "country_y", "continent_hotel") \
             .agg(F.count(F.lit(1)).alias("bookings"))


_CAP_COLS = ["rate", "total_guests", "stay_nights"]


def _capped(spark, sf, method):
    # the columns are bookings': no need for the hotels; several passes read them, so they are stored once
    df = cut_lineage(FX.bookings(spark, sf).select("booking_id", *_CAP_COLS))
    capped = S.cap_outliers(df, S.fit_outlier_bounds(df, _CAP_COLS, method), _CAP_COLS)
    return capped.select("booking_id", *[F.round(c, 8).alias(c) for c in _CAP_COLS])


def q_iqr_capping(spark, sf):
    """I1."""
    return _capped(spark, sf, "iqr")


def q_quantile_capping(spark, sf):
    """I2."""
    return _capped(spark, sf, "quantile")


def q_outlier_counts(spark, sf):
    """I3 (+ the bounds themselves)."""
    df = cut_lineage(FX.bookings(spark, sf).select(*_CAP_COLS))
    b = S.fit_outlier_bounds(df, _CAP_COLS, "iqr")
    return S.outlier_counts(df, b, _CAP_COLS).join(b, "column").select(
        "column", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"), "outliers")


def q_impute_mean_median_mode(spark, sf):
    """I5-I7, A2."""
    df = cut_lineage(FX.bookings(spark, sf).withColumnRenamed("country", "country_x").select(
        "booking_id", "rate", "special_requests", "total_guests", "stay_nights", "board", "country_x", "reservation_status"))
    # one row of fitted values for all columns, one projection
    fills = S.fit_imputer(df, ["rate", "special_requests"], ["board", "country_x"], "mean").crossJoin(
        S.fit_imputer(df, ["total_guests", "stay_nights"], [], "median"))
    out = S.impute_constant(S.apply_imputer(df, fills), {"reservation_status": "missing"})
    return _rounded(out, "total_guests", "stay_nights")


def q_standard_scaling(spark, sf):
    """I8 (population std; constant column -> 0; null stays null)."""
    df = merged(spark, sf).select("booking_id", "rate", "stay_nights", "avg_review")
    cols = ["rate", "stay_nights", "avg_review"]
    out = S.apply_scaler(df, S.fit_scaler(df, cols))
    return out.select("booking_id", *[F.round(c, 6).alias(c) for c in cols])


def q_one_hot_board(spark, sf):
    """I9 (expression form; unseen / null -> all zeros)."""
    df = merged(spark, sf).select("booking_id", "board")
    return S.one_hot_columns(df, "board", ["BB", "FB", "HB", "SC"]).drop("board")


def q_gift_imputation(spark, sf):
    """I11."""
    df = S.impute_for_gifting(merged(spark, sf), AS_OF)
    return df.select("booking_id", "stay_nights", "total_guests", "rate", "board",
                     "required_car_parking_spaces", "special_requests", "reservation_status", "country_x",
                     "hotel_type", "country_y", "parking", "total_rooms", "restaurant", "pool_and_spa",
                     "avg_review", _ts("arrival_date"))


def q_stratified_split(spark, sf):
    """K1."""
    df = cut_lineage(closed(spark, sf).select("booking_id", "target"))
    return SP.stratified_split(df, "target", "booking_id", K.TEST_FRACTION, K.SEED)


def q_stratified_folds(spark, sf):
    """K3 (3 folds, as the search)."""
    df = cut_lineage(closed(spark, sf).select("booking_id", "target"))
    return SP.stratified_folds(df, "target", "booking_id", 3, K.SEED)


def q_group_folds(spark, sf):
    """K2: 7 folds grouped by hotel."""
    df = closed(spark, sf).select("booking_id", "hotel_id", "target")
    return SP.stratified_group_folds(df, "target", "hotel_id", K.GROUP_FOLDS, K.SEED)


def q_group_folds_even(spark, sf):
    """K2 by least deviation: 7 folds grouped by hotel, class shares as even as each step allows."""
    df = closed(spark, sf).select("booking_id", "hotel_id", "target")
    return SP.least_deviation_group_folds(df, "target", "hotel_id", (0, 1), K.GROUP_FOLDS, K.SEED)


def q_class_weights(spark, sf):
    """B4."""
    from staysense.operators.balance import class_weight
    df = closed(spark, sf).select("booking_id", "target")
    return class_weight(df, "target", K.POSITIVE_CLASS_WEIGHT)


def q_scorecard_probability(spark, sf):
    """Probability and decision with the fallback threshold."""
    df = G.score_with_threshold(scored_closed(spark, sf), THRESHOLD, "score", "prediction")
    return df.select("booking_id", "label", "score", "prediction")


def q_fbeta_threshold(spark, sf):
    """V1, T4 (beta = 1 as called by the trainer)."""
    return _rounded(M.fbeta_threshold(scored_closed(spark, sf), "label", "score", 1.0), "threshold", "fbeta")


def q_fbeta_threshold_exact(spark, sf):
    """V1 on scores of full precision: the threshold is one of them, and applying it gives its F-beta."""
    df = scored_closed(spark, sf).withColumn("score", F.col("score") + F.col("booking_id") / F.lit(3e9))
    best = M.fbeta_threshold(df, "label", "score", 1.0)
    at = df.crossJoin(F.broadcast(best)).groupBy("threshold", "fbeta").agg(
        F.count_if(F.col("score") == F.col("threshold")).alias("hits"),
        F.count_if((F.col("score") >= F.col("threshold")) & (F.col("label") == 1)).alias("tp"),
        F.count_if(F.col("score") >= F.col("threshold")).alias("flagged"), F.sum("label").alias("positives"))
    return at.select((F.col("hits") > 0).alias("is_a_score"), "tp", "flagged", F.round("fbeta", 9).alias("fbeta"),
                     F.round(2.0 * F.col("tp") / (F.col("flagged") + F.col("positives")), 9).alias("fbeta_applied"))


def q_fbeta_threshold_half(spark, sf):
    """V1 with the function's own default beta = 0.5."""
    return _rounded(M.fbeta_threshold(scored_closed(spark, sf), "label", "score", 0.5), "threshold", "fbeta")


def q_fold_thresholds(spark, sf):
    """Per-fold F1 threshold over the 7 group folds."""
    df = SP.stratified_group_folds(scored_closed(spark, sf), "label", "hotel_id", K.GROUP_FOLDS, K.SEED)
    return _rounded(M.fbeta_threshold(df, "label", "score", 1.0, by=["fold"]), "threshold", "fbeta")


def q_threshold_grid(spark, sf):
    """V2."""
    return _rounded(M.threshold_grid_search(scored_closed(spark, sf), "label", "score"), "best_threshold", "best_f1")


def q_threshold_sweep(spark, sf):
    """V3."""
    return M.threshold_sweep(scored_closed(spark, sf), "label", "score")


def q_confusion_and_rates(spark, sf):
    """V4, V5, V8."""
    return M.confusion_and_rates(scored_closed(spark, sf), THRESHOLD, "label", "score")


def q_classification_report(spark, sf):
    """V9."""
    df = G.score_with_threshold(scored_closed(spark, sf), THRESHOLD, "score", "prediction")
    return M.classification_report(df, "label", "prediction")


def q_roc_auc(spark, sf):
    """V6."""
    return M.roc_auc(scored_closed(spark, sf), "label", "score")


def q_pr_auc(spark, sf):
    """V7."""
    return M.pr_auc(scored_closed(spark, sf), "label", "score")


def q_gift_candidates(spark, sf):
    """G8 (+G2-G6)."""
    inf = inference(spark, sf)
    imp = S.impute_for_gifting(inf, AS_OF, key_cols=("booking_id", "cancellation_probability", "predicted_to_cancel"))
    c = G.gift_candidates(imp, "booking_id", "cancellation_probability", G.GiftParams(as_of=AS_OF))
    return c.select("booking_id", "gift", "success_probability", "gift_cost", "expected_value",
                    "ev_no_intervention", "beats_no_gift")


def _decisions(df):
    return df.select("booking_id", "cancellation_probability", "predicted_to_cancel", "gift",
                     "cost_of_selected_gift", "final_ev_with_gift_decision", "ev_no_intervention")


def q_gift_decisions(spark, sf):
    """G1-G7, T3 (as coded)."""
    return _decisions(decided(spark, sf))


def q_gift_decisions_intended(spark, sf):
    """G1-G7 with the case-insensitive hotel-type test."""
    return _decisions(decided(spark, sf, "intended"))


def q_campaign_economics(spark, sf):
    """R1, A3, A4 — the flagship question."""
    return R.campaign_economics(decided(spark, sf))


def q_gift_distribution(spark, sf):
    """R2, A5, A6."""
    return R.gift_distribution(decided(spark, sf))


def q_prediction_stats(spark, sf):
    """R3."""
    return R.prediction_stats(inference(spark, sf))


def q_gift_coverage(spark, sf):
    """R4."""
    return R.gift_coverage(decided(spark, sf))


def q_probability_segments(spark, sf):
    """R5, A8, F5."""
    return R.probability_segments(decided(spark, sf), THRESHOLD)


def q_booked_vs_history(spark, sf):
    """O1: open bookings vs. closed history (policy b labels on the history side)."""
    df = inference(spark, sf)
    df = P.label_late_cancellations(P.merge_no_show(P.parse_dates(df, ["reservation_status_date"])), "b")
    return R.booked_vs_history(df)


def q_predictions_export(spark, sf):
    """Key, prediction, '%.4f' probability, gift ('' when none)."""
    return predictions_frame(decided(spark, sf))


# ------------------------------------------------------------ neighbours / balance
def _embeddings(spark, sf, binary: bool = False):
    e = FX.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"),
                                                  F.col("embedding").cast("array<double>").alias("vec"), "label")
    return e.withColumn("label", (F.col("label") == 0).cast("int")) if binary else e


def q_nearest_neighbors(spark, sf):
    """Shared exact kNN (k = 5) used by I4 / B1 / B3."""
    from staysense.operators.neighbors import knn
    e = _embeddings(spark, sf)
    return knn(e, e, k=K.KNN_NEIGHBORS).select("q_id", "n_id", F.round("dist", 9).alias("dist"), "rank")


def q_smote_points(spark, sf):
    """B1: synthetic rows for the minority class (class 0 vs the rest), ratio 0.8, k = 5."""
    from staysense.operators.balance import smote
    syn = smote(_embeddings(spark, sf, binary=True), "label", "vec", "id", K.SMOTE_RATIO, K.KNN_NEIGHBORS, K.SEED)
    return syn.select("id", "label", "parent_id", "neighbor_id", "gap", "sample_no",
                      F.col("vec")[0].alias("vec_first"), F.element_at("vec", -1).alias("vec_last"))


def q_tomek_links(spark, sf):
    """Mutual nearest neighbours with different labels."""
    from staysense.operators.balance import tomek_links
    return tomek_links(_embeddings(spark, sf), "label", "vec", "id")


def q_smote_tomek_balance(spark, sf):
    """B2: class sizes after SMOTE (1:1) + Tomek cleaning."""
    from staysense.operators.balance import smote_tomek
    return smote_tomek(_embeddings(spark, sf, binary=True), "label", "vec", "id").groupBy("label") \
        .agg(F.count(F.lit(1)).alias("rows"))


KNN_IMPUTE_COLUMNS = ["rate", "stay_nights", "total_guests", "lead_time"]


def q_knn_impute(spark, sf):
    """I4: 5-NN imputation with the NaN-aware distance over the numeric booking inputs."""
    from staysense.operators.impute_knn import knn_impute
    df = inference(spark, sf).select("booking_id", *KNN_IMPUTE_COLUMNS)
    out = knn_impute(df, KNN_IMPUTE_COLUMNS, "booking_id", K.KNN_NEIGHBORS, K.SEED)
    return out.select("booking_id", *[F.round(c, 8).alias(c) for c in KNN_IMPUTE_COLUMNS])


def q_knn_impute_unseen(spark, sf):
    """I4 as a fitted step: the imputer of the K1 training rows, saved, read back and applied to the rows held out."""
    import uuid
    from staysense.operators.impute_knn import KnnImputer
    from staysense.session import ensure_checkpoint_dir
    # stored before the split, which reads it three times
    df = cut_lineage(closed(spark, sf).select("booking_id", "target", *KNN_IMPUTE_COLUMNS))
    df = cut_lineage(SP.stratified_split(df, "target", "booking_id", K.TEST_FRACTION, K.SEED))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/knn-imputer-{uuid.uuid4().hex}"
    KnnImputer.fit(df.where("is_test = 0"), KNN_IMPUTE_COLUMNS, "booking_id", K.KNN_NEIGHBORS, K.SEED).save(path)
    out = KnnImputer.load(spark, path).transform(df.where("is_test = 1"), "booking_id")
    return out.select("booking_id", *[F.round(c, 8).alias(c) for c in KNN_IMPUTE_COLUMNS])


def q_variance_filter(spark, sf):
    """M12."""
    from staysense.operators.selection import variance_filter
    return variance_filter(FX.table(spark, sf, "embeddings"), "embedding")


def q_anova_f_topk(spark, sf):
    """Top-22 dimensions by ANOVA F against the 10 labels."""
    from staysense.operators.selection import anova_top_k
    return anova_top_k(FX.table(spark, sf, "embeddings"), "embedding", "label", K.ANOVA_TOP_K)


# ------------------------------------------------------------------------ models
def _model_frame(spark, sf):
    from staysense.plans.train import model_frame
    return model_frame(FX.bookings(spark, sf), FX.hotels(spark, sf))


STACKED_TREES = 50         # the source names no count for its stacking


def q_train_logistic(spark, sf):
    """M3, K1, V2, V4-V8 (E3 flow with the documented best C = 0.1, L2)."""
    from staysense.operators import model as MD
    from staysense.plans.train import holdout_evaluation
    df = _model_frame(spark, sf)
    n = df.count()
    return holdout_evaluation(df, MD.logistic(C=0.1, penalty="l2", n_rows=n))


def q_train_boosted(spark, sf):
    """M1, B4 (positive weight 1.5), K1, V2, V4-V8."""
    from staysense.operators import model as MD
    from staysense.operators.balance import class_weight
    from staysense.plans.train import holdout_evaluation
    df = class_weight(_model_frame(spark, sf), "label", K.POSITIVE_CLASS_WEIGHT)
    return holdout_evaluation(df, MD.boosted_trees(weight="weight"))


def q_cv_threshold(spark, sf):
    """Out-of-fold scores over the 7 hotel-group folds, global and per-fold
    F1 thresholds (logistic pipeline as the template)."""
    from staysense.functions.columns import present
    from staysense.operators import model as MD
    df = SP.stratified_group_folds(_model_frame(spark, sf), "label", "hotel_id", K.GROUP_FOLDS, K.SEED)
    n = df.count()
    pipe = MD.classification_pipeline(MD.logistic(C=0.1, n_rows=n), present(df, MD.NUMERIC), present(df, MD.CATEGORICAL))
    _, glob, per = MD.cross_validated_threshold(df, pipe, "fold", "label", "booking_id", 1.0)
    return per.unionByName(glob.select(F.lit(None).cast("int").alias("fold"), "threshold", "fbeta"))


def q_early_stopping(spark, sf):
    """M2: boosted trees with a validation split (the K1 test rows) and tolerance-based
    early stopping; trees kept and validation metrics."""
    from staysense.functions.columns import present
    from staysense.operators import model as MD
    df = SP.stratified_split(_model_frame(spark, sf), "label", "booking_id", K.TEST_FRACTION, K.SEED)
    model, trees = MD.early_stopped_boosting(df.withColumnRenamed("is_test", "is_valid"), present(df, MD.NUMERIC),
                                             present(df, MD.CATEGORICAL), "is_valid")
    valid = MD.positive_probability(model.transform(df.where(F.col("is_test") == 1)))
    return M.roc_auc(valid, "label", "score").select(F.lit(trees).alias("trees_kept"), "roc_auc")


def q_stacked_scores(spark, sf):
    """O3: random-forest and boosted-tree out-of-fold scores (3 stratified folds) stacked
    with a logistic meta-model; AUC of each column."""
    from pyspark.ml.classification import RandomForestClassifier
    from staysense.functions.columns import present
    from staysense.operators import model as MD
    df = SP.stratified_folds(cut_lineage(_model_frame(spark, sf)), "label", "booking_id", 3, K.SEED)
    bases = {"rf": RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=STACKED_TREES,
                                          seed=K.SEED),
             "gbt": MD.boosted_trees(max_iter=STACKED_TREES)}
    st = MD.stacked_scores(df, bases, present(df, MD.NUMERIC), present(df, MD.CATEGORICAL), "fold")
    out = None
    for c in ["score_rf", "score_gbt", "score"]:
        a = M.roc_auc(st, "label", c).select(F.lit(c).alias("model"), "roc_auc")
        out = a if out is None else out.unionByName(a)
    return out


def _search(spark, sf, random_pick: bool):
    from staysense.functions.columns import present
    from staysense.operators import model as MD
    df = dealt(SP.stratified_folds(cut_lineage(_model_frame(spark, sf)), "label", "booking_id", 3, K.SEED))
    n = df.count()
    lr = MD.logistic(n_rows=n)
    pipe = MD.classification_pipeline(lr, present(df, MD.NUMERIC), present(df, MD.CATEGORICAL))
    grid = MD.logistic_grid(n)
    cv = (MD.random_search(pipe, lr, grid, fold_col="fold") if random_pick
          else MD.grid_search(pipe, lr, grid, fold_col="fold"))
    fitted = cv.fit(df)
    rows = [(float(pm[lr.getParam("regParam")]), float(pm[lr.getParam("elasticNetParam")]), float(m))
            for pm, m in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics)]
    return spark.createDataFrame(rows, "reg_param double, elastic_net double, mean_f1 double")


def q_grid_search(spark, sf):
    """M7: C x penalty grid, 3 stratified folds, F1 of the positive class."""
    return _search(spark, sf, False)


def q_random_search(spark, sf):
    """M6: up to 20 seeded draws without replacement; the logistic space has ten combinations."""
    return _search(spark, sf, True)


def q_feature_importance(spark, sf):
    """Fit, save the package, reload it (fallback threshold when the
    table is absent) and count splits per named feature from the saved trees."""
    from staysense.functions.columns import present
    from staysense.operators import model as MD
    from staysense.session import ensure_checkpoint_dir
    df = dealt(_model_frame(spark, sf))
    pipe = MD.classification_pipeline(MD.boosted_trees(), present(df, MD.NUMERIC),
                                      present(df, MD.CATEGORICAL))
    model = pipe.fit(df)
    import uuid
    base = f"{ensure_checkpoint_dir(spark).rstrip(chr(47))}/model_package-{uuid.uuid4().hex}"       # a folder of this run
    MD.save_model_package(model, K.DEFAULT_FALLBACK_THRESHOLD, base)
    loaded, _thr = MD.load_model_package(base)
    names = MD.feature_names(loaded.transform(df.limit(1)))
    return MD.split_count_importance(f"{base}/pipeline/stages/{len(loaded.stages) - 1}_" +
                                     loaded.stages[-1].uid, names, top=20)


# -------------------------------------------------- second-order boosting
BOOST_FEATURES = ["rate", "stay_nights", "total_guests", "required_car_parking_spaces", "special_requests", "lead_time",
                  "total_rooms", "avg_review", "parking", "restaurant", "pool_and_spa"]
BOOST_ROUNDS = 2           # of the checked queries; the operator's default is the source's 300


def _boosted(spark, sf, **change):
    """(model of the K1 training rows, all rows); the K1 test rows are its validation rows."""
    from dataclasses import replace
    from staysense.operators import boosting as B
    from staysense.session import cut_lineage
    df = cut_lineage(SP.stratified_split(_model_frame(spark, sf), "label", "booking_id", K.TEST_FRACTION, K.SEED))
    params = replace(B.BoostParams(rounds=BOOST_ROUNDS), **change)
    return B.fit(df, BOOST_FEATURES, "label", "booking_id", params, "is_test", curve=True), df


def q_boosted_nodes(spark, sf):
    """M1: the node table of the first rounds (all production values but the number of rounds)."""
    model, _ = _boosted(spark, sf)
    return model.table(spark).select("tree", "node", "feature", "threshold", "missing_left", F.round("gain", 9).alias("gain"),
                                     F.round("cover", 9).alias("cover"), F.round("value", 12).alias("value"))


def q_boosted_loss_curve(spark, sf):
    """M2: log loss of the validation rows after each of the first rounds, and the best round so far."""
    model, _ = _boosted(spark, sf)
    best = [min(range(i + 1), key=model.losses.__getitem__) for i in range(len(model.losses))]
    rows = [(i, round(x, 9), b) for i, (x, b) in enumerate(zip(model.losses, best))]
    return spark.createDataFrame(rows, "round int, log_loss double, best_round int")


def q_boosted_scores(spark, sf):
    """The model saved, read back and applied to every row by expressions over its node table."""
    import uuid
    from staysense.operators import boosting as B
    from staysense.session import ensure_checkpoint_dir
    model, df = _boosted(spark, sf)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/boosted-{uuid.uuid4().hex}"
    model.save(spark, path)
    return B.Booster.load(spark, path).score(df).select("booking_id", "is_test", F.round("score", 12).alias("score"))


def q_boosted_importance(spark, sf):
    """Splits per feature, counted in the node table."""
    from staysense.operators import boosting as B
    model, _ = _boosted(spark, sf)
    return B.split_counts(model.table(spark), model.features)


QUERIES = {name[2:]: fn for name, fn in dict(globals()).items() if name.startswith("q_") and callable(fn)}
