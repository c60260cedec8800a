"""Streaming scoring gives the same decisions as the batch flow on the same rows."""

import tempfile

from pyspark.sql import functions as F

from staysense.operators import gifts as G
from staysense.plans import catalog as C
from staysense.sources import fixtures as FX
from staysense.streaming.scoring import start_scoring
from conftest import SF_SMALL


def test_stream_matches_batch(spark):
    src = tempfile.mkdtemp(prefix="stream-src-", dir="/tmp")
    sink = tempfile.mkdtemp(prefix="stream-sink-", dir="/tmp")
    bookings = FX.bookings(spark, SF_SMALL)
    bookings.repartition(4).write.mode("overwrite").parquet(src + "/in")
    q = start_scoring(spark, src + "/in", bookings.schema, FX.hotels(spark, SF_SMALL), bookings, sink,
                      params=G.GiftParams(as_of=C.AS_OF))
    q.awaitTermination(300)
    got = spark.read.parquet(sink).select("booking_id", "gift", "final_ev_with_gift_decision")
    want = C.decided(spark, SF_SMALL).select("booking_id", "gift", "final_ev_with_gift_decision")
    assert got.count() == want.count()
    diff = got.exceptAll(want).count() + want.exceptAll(got).count()
    assert diff == 0
    assert got.where(F.col("gift").isNotNull()).count() > 0


def test_restart_goes_on_with_new_files(spark):
    src = tempfile.mkdtemp(prefix="stream-src-", dir="/tmp") + "/in"
    sink = tempfile.mkdtemp(prefix="stream-sink-", dir="/tmp")
    bookings, hotels = FX.bookings(spark, SF_SMALL), FX.hotels(spark, SF_SMALL)
    for part in (0, 1):
        bookings.where(F.col("booking_id") % 2 == part).coalesce(2).write.mode("append").parquet(src)
        q = start_scoring(spark, src, bookings.schema, hotels, bookings, sink, params=G.GiftParams(as_of=C.AS_OF))
        q.awaitTermination(300)
    got = spark.read.parquet(sink)
    assert got.count() == got.select("booking_id").distinct().count() == bookings.count()
