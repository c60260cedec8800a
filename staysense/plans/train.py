"""E1 / E3 training flows built from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staysense.functions import constants as K
from staysense.operators import metrics as MET
from staysense.operators import model as MD
from staysense.operators import prepare as P
from staysense.operators import split as SP
from staysense.session import cut_lineage, dealt


def model_frame(bookings: DataFrame, hotels: DataFrame, policy: str = "b") -> DataFrame:
    """Labelled closed bookings with the model inputs (booleans as 0/1 doubles)."""
    df = P.training_frame(bookings, hotels, policy).withColumnRenamed("target", "label")
    from staysense.functions.columns import present
    cols = ["booking_id", "hotel_id", "label"] + present(df, MD.NUMERIC + MD.CATEGORICAL)
    return MD.cast_booleans(df.select(*cols), [c for c in ("parking", "restaurant", "pool_and_spa") if c in cols])


def holdout_evaluation(df: DataFrame, estimator, test_fraction: float = K.TEST_FRACTION,
                       seed: int = K.SEED) -> DataFrame:
    """Stratified split, fit preprocessing + model on train, grid-optimal threshold
    on test, metrics row (accuracy, precision, recall, F1, ROC AUC, PR AUC)."""
    from staysense.functions.columns import present
    df = cut_lineage(df)        # the split reads it three times, and what it gives is counted and dealt
    s = dealt(SP.stratified_split(df, "label", "booking_id", test_fraction, seed))
    train, test = s.where(F.col("is_test") == 0), s.where(F.col("is_test") == 1)
    pipe = MD.classification_pipeline(estimator, present(df, MD.NUMERIC), present(df, MD.CATEGORICAL))
    model = pipe.fit(train)
    scored = cut_lineage(MD.positive_probability(model.transform(test)).select("label", "score"))
    best = MET.threshold_grid_search(scored, "label", "score").first()
    thr = best["best_threshold"]
    cm = MET.confusion_and_rates(scored, thr, "label", "score")
    auc = MET.roc_auc(scored, "label", "score").crossJoin(MET.pr_auc(scored, "label", "score"))
    return cm.crossJoin(auc).select(F.lit(float(thr)).alias("threshold"), "*")


def train_package(bookings: DataFrame, hotels: DataFrame, path: str, estimator=None, folds: int = K.GROUP_FOLDS,
                  ratio: float = K.SMOTE_RATIO, seed: int = K.SEED) -> tuple[DataFrame, float]:
    """Group folds by hotel, per fold preprocessing -> SMOTE -> boosted trees (300 by default),
    one F1 threshold over all out-of-fold scores, refit on every row, model and threshold saved
    together.  Returns the out-of-fold scores and the threshold."""
    from staysense.functions.columns import present
    df = SP.stratified_group_folds(model_frame(bookings, hotels), "label", "hotel_id", folds, seed)
    df = dealt(df)
    pipe = MD.BalancedPipeline(estimator or MD.boosted_trees(), present(df, MD.NUMERIC), present(df, MD.CATEGORICAL),
                               ratio, seed=seed)
    oof, best, _ = MD.cross_validated_threshold(df, pipe, "fold", "label", "booking_id", 1.0)
    threshold = best.first()["threshold"]
    MD.save_model_package(pipe.fit(df), threshold, path)
    return oof, threshold
