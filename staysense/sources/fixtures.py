"""Fixture views over the driver's TPC-H-like tables (see FIXTURES.md §2).

``hotels`` comes from ``supplier`` and ``bookings`` from ``orders ⋈ customer``.
Both are pure projections/joins, so Catalyst prunes columns and pushes filters
into the Parquet scans; nothing here collects or samples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: nation key -> 3-letter code used by the fixture views -------
COUNTRY_CODES = ["SPA", "FRA", "POR", "GBR", "DEU", "ITA", "USA", "MEX", "BRA", "ARG",
                 "CHN", "JPN", "AUS", "NZL", "MAR", "EGY", "CN", "XXX", "ZZZ", "NLD",
                 "SWE", "CAN", "PER", "IND", "ZAF"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_CODES_SQL = "array(" + ", ".join(f"'{c}'" for c in COUNTRY_CODES) + ")"


def _code(key: str) -> str:
    return f"try_element_at({_CODES_SQL}, {key} + 1)"


# Each column is one SQL expression string: a single JVM call per column when the
# plan is built (Column-operator chains cost one driver round trip per operator).
def hotels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('h', CAST(s_suppkey AS STRING)) AS hotel_id",
        "CASE WHEN s_suppkey % 2 = 0 THEN 'City Hotel' ELSE 'Resort Hotel' END AS hotel_type",
        f"{_code('s_nationkey')} AS country",
        "s_suppkey % 3 = 0 AS parking",
        "CAST(39 + (s_suppkey % 10) * 10 AS INT) AS total_rooms",
        "s_suppkey % 4 != 0 AS restaurant",
        "s_suppkey % 5 != 0 AS pool_and_spa",
        "CAST(340 + (s_suppkey % 10) * 14 AS DOUBLE) / 100.0D AS avg_review",
    )


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One booking per order (o_orderkey is unique), at the hotel of its least supplier key; an
    order without lines names a hotel that does not exist.  The joins are shuffle joins on
    the customer and order keys at scale; AQE may turn them into broadcasts when small."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                               "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    stays = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_suppkey").alias("hotel_key"))
    b = o.join(c, o.o_custkey == c.c_custkey).join(stays, "o_orderkey", "left")
    # bigint arithmetic: identical to the int fixture while keys fit in int, no overflow beyond
    arrival = "o_orderdate + make_dt_interval(CAST((o_orderkey * 7) % 200 AS INT))"

    def null_if(m: int, v: str) -> str:
        return f"CASE WHEN o_orderkey % {m} = 0 THEN NULL ELSE {v} END"
    return b.selectExpr(
        "o_orderkey AS booking_id",
        "concat('h', CAST(coalesce(hotel_key, -1) AS STRING)) AS hotel_id",
        "CASE WHEN o_orderkey % 97 = 0 THEN CAST(NULL AS STRING) WHEN o_orderstatus = 'F' THEN 'Check-Out' "
        "WHEN o_orderstatus = 'P' THEN 'Canceled' WHEN o_orderkey % 3 = 0 THEN 'Booked' "
        "WHEN o_orderkey % 3 = 1 THEN 'No-Show' ELSE 'Check-Out' END AS reservation_status",
        "o_orderdate AS booking_date",
        f"{arrival} AS arrival_date",
        f"{arrival} + make_dt_interval(CAST(5 - (o_orderkey * 13) % 60 AS INT)) AS reservation_status_date",
        f"{null_if(53, 'o_totalprice / 100.0D')} AS rate",
        f"{null_if(59, 'CAST(o_orderkey % 16 AS DOUBLE)')} AS stay_nights",
        f"{null_if(61, 'CAST(1 + o_orderkey % 5 AS DOUBLE)')} AS total_guests",
        f"{null_if(2, 'CAST(o_orderkey % 3 AS DOUBLE)')} AS required_car_parking_spaces",
        f"{null_if(7, 'CAST(o_orderkey % 4 AS DOUBLE)')} AS special_requests",
        "CASE WHEN o_orderkey % 6 = 0 THEN 'BB' WHEN o_orderkey % 6 = 1 THEN 'HB' WHEN o_orderkey % 6 = 2 THEN 'FB' "
        "WHEN o_orderkey % 6 = 3 THEN CAST(NULL AS STRING) ELSE 'SC' END AS board",
        f"{null_if(31, _code('c_nationkey'))} AS country",
    )
