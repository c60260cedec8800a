"""Readers and writers with explicit schemas.

* CSV is read as text by its header and cast to a fixed ``StructType`` (no inference pass
  over the data); dates stay strings and are parsed by ``operators.prepare``.
* Writers add the booking key: Spark has no row order, so positional output
  (as in a single-process CSV dump) would not be reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOTELS_SCHEMA = T.StructType([
    T.StructField("hotel_id", T.StringType(), False),
    T.StructField("hotel_type", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("parking", T.BooleanType(), True),
    T.StructField("total_rooms", T.IntegerType(), True),
    T.StructField("restaurant", T.BooleanType(), True),
    T.StructField("pool_and_spa", T.BooleanType(), True),
    T.StructField("avg_review", T.DoubleType(), True),
])

BOOKINGS_SCHEMA = T.StructType([
    T.StructField("booking_id", T.LongType(), False),
    T.StructField("hotel_id", T.StringType(), True),
    T.StructField("reservation_status", T.StringType(), True),
    T.StructField("booking_date", T.StringType(), True),
    T.StructField("arrival_date", T.StringType(), True),
    T.StructField("reservation_status_date", T.StringType(), True),
    T.StructField("rate", T.DoubleType(), True),
    T.StructField("stay_nights", T.DoubleType(), True),
    T.StructField("total_guests", T.DoubleType(), True),
    T.StructField("required_car_parking_spaces", T.DoubleType(), True),
    T.StructField("special_requests", T.DoubleType(), True),
    T.StructField("board", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
])


def _typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` that are there, by name and with its types (what cannot be read
    becomes null); other columns stay as they are, absent ones stay absent."""
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    return raw.select(*[F.expr(f"try_cast(trim(`{c}`) AS {types[c]})").alias(c) if c in types else F.col(f"`{c}`")
                        for c in raw.columns])


def _read(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    # all text, columns by the header: no inference pass, any order, any extra columns
    return _typed(spark.read.option("header", True).option("inferSchema", False).csv(path), schema)


def read_hotels(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Hotels dimension.  Booleans accept True/False text."""
    return _read(spark, path, fmt, HOTELS_SCHEMA)


def read_bookings(spark: SparkSession, path: str, fmt: str = "csv",
                  schema: T.StructType = BOOKINGS_SCHEMA, key: str = "booking_id") -> DataFrame:
    """Bookings (train or inference batch); the same reader serves both.  A file without
    the key gets one from the rows' content."""
    df = _read(spark, path, fmt, schema)
    return df if key in df.columns else with_key(df, key)


def with_key(df: DataFrame, key: str = "booking_id") -> DataFrame:
    """A 64-bit key of the row's content and, among equal rows, of their number: the same in
    every run and on any partitioning."""
    content = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00null")) for c in df.columns])
    same = Window.partitionBy("_content").orderBy(F.lit(1))
    out = df.withColumn("_content", content).withColumn("_n", F.row_number().over(same))
    return out.select(F.xxhash64("_content", "_n").alias(key), *[F.col(f"`{c}`") for c in df.columns])


def _fmt4(c):
    # one rounding, HALF_UP, of the shortest decimal that stands for the double
    return F.round(c.cast("decimal(38,18)"), 4).cast("decimal(20,4)").cast("string")


def predictions_frame(scored: DataFrame, key: str = "booking_id",
                      prediction: str = "predicted_to_cancel",
                      probability: str = "cancellation_probability",
                      gift: str | None = "gift",
                      names: tuple[str, str, str] = ("prediction", "probability", "gift")) -> DataFrame:
    """S4/S5 output columns: key, 0/1 prediction, probability as '%.4f' text, gift ('' when none)."""
    cols = [F.col(key), F.col(prediction).cast("int").alias(names[0]),
            _fmt4(F.col(probability)).alias(names[1])]
    if gift is not None:
        cols.append(F.coalesce(F.col(gift), F.lit("")).alias(names[2]))
    return scored.select(*cols)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Distributed CSV write (one file per task; no coalesce(1) through one task)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_importance(importance: DataFrame, path: str) -> None:
    """The feature importance file (``Feature``, ``Importance``)."""
    write_csv(importance.select(F.col("feature").alias("Feature"), F.col("importance").alias("Importance")), path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
