"""Model operators: E1 with SMOTE in the folds, E2 with the saved package, small model properties."""

import pytest
from pyspark.sql import functions as F

from staysense.functions import constants as K
from staysense.operators import gifts as G
from staysense.operators import metrics as M
from staysense.operators import model as MD
from staysense.plans import score as SC
from staysense.plans import train as TR
from staysense.sources import fixtures as FX
from conftest import SF_SMALL


def planted(spark, n=900):
    """A label drawn from a known logistic score by a hash; a third of the rows are positive."""
    u = "(pmod(xxhash64(id, 'u'), 100000) / 100000.0)"
    x = "(pmod(xxhash64(id, 'x'), 100000) / 100000.0)"
    return spark.range(n).selectExpr(
        "id AS booking_id", f"{x} AS rate", "CASE WHEN id % 9 = 0 THEN NULL ELSE CAST(id % 5 AS DOUBLE) END AS stay_nights",
        "CASE WHEN id % 3 = 0 THEN 'SC' WHEN id % 3 = 1 THEN 'BB' END AS board", "id % 3 AS fold",
        f"CAST({u} < 1 / (1 + exp(3.0 - 5.0 * {x})) AS INT) AS label").withColumn("rate", F.col("rate").cast("double"))


def test_boosted_trees_beat_a_constant_and_stay_the_same(spark, tmp_path):
    df = planted(spark)
    pipe = MD.classification_pipeline(MD.boosted_trees(max_iter=5), ["rate", "stay_nights"], ["board"])
    model = pipe.fit(df.where("fold <> 0"))
    test = df.where("fold = 0")
    scored = MD.positive_probability(model.transform(test))
    assert M.roc_auc(scored, "label", "score").first()[0] > 0.65
    MD.save_model_package(model, 0.3, str(tmp_path / "package"))
    again, threshold = MD.load_model_package(str(tmp_path / "package"))
    assert threshold == 0.3
    a = {r.booking_id: r.score for r in scored.select("booking_id", "score").collect()}
    assert a == {r.booking_id: r.score for r in MD.positive_probability(again.transform(test)).collect()}
    unseen = test.limit(5).withColumn("board", F.lit("never seen"))
    encoded = again.transform(unseen).select("board__ohe").first()[0]
    assert encoded.toArray().sum() == 0


def test_absent_threshold_falls_back_and_other_errors_do_not(spark, tmp_path):
    df = planted(spark, 120)
    model = MD.classification_pipeline(MD.logistic(), ["rate"], []).fit(df)
    model.write().save(str(tmp_path / "p" / "pipeline"))
    assert MD.load_model_package(str(tmp_path / "p"))[1] == K.DEFAULT_FALLBACK_THRESHOLD
    (tmp_path / "p" / "threshold").mkdir()
    (tmp_path / "p" / "threshold" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        MD.load_model_package(str(tmp_path / "p"))


def test_no_usable_fold_gives_the_default_threshold(spark):
    df = planted(spark, 60).withColumn("label", F.lit(0))
    pipe = MD.classification_pipeline(MD.logistic(), ["rate"], [])
    oof, best, _ = MD.cross_validated_threshold(df, pipe)
    assert oof.count() == 0 and tuple(best.first()) == (0.5, 0.0)


def test_smote_balances_in_fit_only(spark):
    df = planted(spark).where("label = 0 OR booking_id % 3 = 0")
    pipe = MD.BalancedPipeline(MD.logistic(), ["rate", "stay_nights"], ["board"])
    prepared = MD.Pipeline(stages=pipe.stages).fit(df).transform(df)
    n = {r.label: r["count"] for r in pipe.balanced(prepared).groupBy("label").count().collect()}
    assert n[1] == int(K.SMOTE_RATIO * n[0]) and n[0] == df.where("label = 0").count()
    assert pipe.fit(df).transform(df).count() == df.count()


def test_trained_package_scores_bookings_and_decides_gifts(spark, tmp_path):
    bookings, hotels = FX.bookings(spark, SF_SMALL), FX.hotels(spark, SF_SMALL)
    path = str(tmp_path / "e1")
    oof, threshold = TR.train_package(bookings, hotels, path, MD.boosted_trees(max_iter=3, max_depth=3), folds=2)
    assert oof.count() == TR.model_frame(bookings, hotels).count()
    assert oof.where(F.col("score") == threshold).count() > 0
    probability, stored = SC.package_probability(path)
    assert stored == threshold
    scored = SC.score_bookings(bookings, hotels, stored, probability)
    out = SC.decide(scored, stored, G.GiftParams(as_of="2000-01-01 00:00:00"))
    assert out.count() == bookings.count()
    assert out.where("gift IS NOT NULL AND predicted_to_cancel = 0").count() == 0
    assert out.where("cancellation_probability NOT BETWEEN 0 AND 1").count() == 0


def test_training_rows_are_dealt_to_tasks(spark):
    from staysense.session import dealt
    df = spark.range(50_000).coalesce(1)
    out = dealt(df)
    sizes = out.rdd.mapPartitions(lambda x: [sum(1 for _ in x)]).collect()
    assert sum(sizes) == 50_000 and max(sizes) <= 26_000
    assert dealt(df.limit(100)).rdd.getNumPartitions() == 1
    assert max(dealt(df, 50_000, 9_000).rdd.mapPartitions(lambda x: [sum(1 for _ in x)]).collect()) <= 9_000


def test_grid_search_prepares_once_a_fold_and_scores_as_the_plain_search(spark):
    df = planted(spark).cache()
    fits = []

    class Counted(MD.ModeImputer):
        def _fit(self, rows):
            fits.append(1)
            return super()._fit(rows)

    lr = MD.logistic(n_rows=900)
    stages = MD.preprocessing_stages(["rate", "stay_nights"], ["board"])
    stages = [Counted(inputCols=["board"]) if isinstance(s, MD.ModeImputer) else s for s in stages]
    grid = {"regParam": [0.001, 0.1], "elasticNetParam": [1.0, 0.0]}
    cv = MD.grid_search(MD.Pipeline(stages=stages + [lr]), lr, grid)
    got = cv.fit(df)
    assert len(fits) == 3 + 1                                   # a fold each, and the refit
    plain = MD.CrossValidator(estimator=cv.getEstimator(), estimatorParamMaps=cv.getEstimatorParamMaps(),
                              evaluator=cv.getEvaluator(), foldCol="fold", seed=K.SEED).fit(df)
    assert got.avgMetrics == pytest.approx(plain.avgMetrics) and max(got.avgMetrics) > 0
    assert got.bestModel.stages[-1].coefficients.toArray() == pytest.approx(plain.bestModel.stages[-1].coefficients.toArray())
