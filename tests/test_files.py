"""Readers on files shaped like the source's, writers read back."""

from pyspark.sql import functions as F

from staysense.operators import gifts as G
from staysense.operators import prepare as P
from staysense.sources import io

HOTELS = """hotel_id,hotel_type,country,parking,total_rooms,restaurant,pool_and_spa,avg_review
c1,City Hotel,FRA,True,95,False,True,4.5
r1,Resort Hotel,POR,False,oops,True,,
"""
BOOKINGS = """country,board,hotel_id,reservation_status,booking_date,arrival_date,reservation_status_date,rate,stay_nights,total_guests,required_car_parking_spaces,special_requests,market
FRA,SC,c1,Canceled,2020-01-02,2020-02-01,2020-01-20,400.5,2,2,,1,web
SPA,BB,zz,Check-Out,not a date,2020-03-01 10:00:00,2020-03-03,n/a,,1,1.0,,shop
SPA,BB,zz,Check-Out,not a date,2020-03-01 10:00:00,2020-03-03,n/a,,1,1.0,,shop
"""


def _file(folder, name, text):
    (folder / name).write_text(text)
    return str(folder / name)


def test_read_hotels(spark, tmp_path):
    rows = io.read_hotels(spark, _file(tmp_path, "hotels.csv", HOTELS)).collect()
    assert tuple(rows[0]) == ("c1", "City Hotel", "FRA", True, 95, False, True, 4.5)
    assert rows[1].total_rooms is None and rows[1].pool_and_spa is None and rows[1].parking is False


def test_read_bookings_without_key_and_with_extra_columns(spark, tmp_path):
    path = _file(tmp_path, "bookings.csv", BOOKINGS)
    df = io.read_bookings(spark, path)
    rows = df.orderBy("country").collect()
    assert rows[0].rate == 400.5 and rows[0].market == "web" and rows[1].rate is None and rows[1].stay_nights is None
    keys = {r.booking_id for r in rows}
    assert len(keys) == 3 and keys == {r.booking_id for r in io.read_bookings(spark, path).repartition(3).collect()}
    labelled = P.training_frame(df, io.read_hotels(spark, _file(tmp_path, "hotels.csv", HOTELS))).orderBy("country_x").collect()
    assert [r.target for r in labelled] == [1, 0, 0] and labelled[1].booking_date is None
    assert str(labelled[1].arrival_date) == "2020-03-01 10:00:00"


def test_predictions_and_importance_files(spark, tmp_path):
    scored = spark.createDataFrame([(1, 1, 0.75, "A"), (2, 0, 0.25, None)],
                                   "booking_id int, predicted_to_cancel int, cancellation_probability double, gift string")
    io.write_csv(io.predictions_frame(scored), str(tmp_path / "full"))
    io.write_csv(io.predictions_frame(scored, gift=None, names=("predicted_cancellation", "probability_cancellation", "")),
                 str(tmp_path / "simple"))
    full = spark.read.option("header", True).csv(str(tmp_path / "full")).orderBy("booking_id").collect()
    assert [tuple(r) for r in full] == [("1", "1", "0.7500", "A"), ("2", "0", "0.2500", None)]
    simple = spark.read.option("header", True).csv(str(tmp_path / "simple"))
    assert simple.columns == ["booking_id", "predicted_cancellation", "probability_cancellation"] and simple.count() == 2
    io.write_importance(spark.createDataFrame([("rate", 7), ("board", 2)], "feature string, importance long"), str(tmp_path / "imp"))
    assert sorted(map(tuple, spark.read.option("header", True).csv(str(tmp_path / "imp")).collect())) == [("board", "2"), ("rate", "7")]


def test_gift_decision_without_hotel_columns(spark):
    df = spark.createDataFrame([(1, 0.9, 400.0)], "booking_id int, cancellation_probability double, rate double")
    r = G.decide_gifts(df, 0.5).first()
    assert r.gift is None and r.ev_no_intervention > 0
    assert G.decide_gifts(df.withColumn("parking", F.lit(True)), 0.5).first().gift == "C"
