"""Session logs: the schema contract, and a view of the event tables in their shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns that raw sessions must have.
SESSION_SCHEMA = T.StructType([
    T.StructField("session_id", T.LongType()), T.StructField("source_ip", T.StringType()), T.StructField("destination_ip", T.StringType()),
    T.StructField("source_port", T.IntegerType()), T.StructField("destination_port", T.IntegerType()),
    T.StructField("event_start", T.TimestampType()), T.StructField("event_end", T.TimestampType()),
    T.StructField("source_bytes", T.DoubleType()), T.StructField("destination_bytes", T.DoubleType()),
    T.StructField("event_action", T.StringType()), T.StructField("event_reason", T.StringType()),
    T.StructField("event_name", T.StringType()), T.StructField("network_transport", T.StringType()),
])
REQUIRED = tuple(f.name for f in SESSION_SCHEMA if f.name != "session_id")

#: Port sets by name: small reference data.
PORT_SETS = {"HIGH_RISK_PORT": [445, 3389], "ADMIN_PORT": [22, 3389], "FILESHARE_PORT": [445], "DIRECTORY_PORT": [389], "DB_PORT": [3306]}
PORTS = [22, 53, 80, 443, 445, 389, 3306, 3389]
TRANSPORTS = ["TCP", "UDP", "ICMP"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as raw sessions. Times are UTC, as everywhere in this package."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    e = table(spark, sf_dir, "events").withColumn("k", F.regexp_extract("props", "[0-9]+", 0).cast("long"))
    ip = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    pick = lambda values, n: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("k") % n + 1).cast("int"))
    start = F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    return e.select(
        F.col("event_id").alias("session_id"),
        ip("10.0.", F.col("user_id") % 16, ".", F.floor(F.col("user_id") / 16) % 250 + 1).alias("source_ip"),
        ip("172.16.", F.col("k") % 8, ".", F.col("k") + 1).alias("destination_ip"),
        (F.col("event_id") % 1000 + 40000).cast("int").alias("source_port"),
        pick(PORTS, 8).cast("int").alias("destination_port"),
        start.alias("event_start"),
        F.timestamp_add("SECOND", F.floor("value").cast("int"), start).alias("event_end"),
        F.when(F.col("event_id") % 37 == 0, F.lit(-1.0)).otherwise(F.floor(F.col("value") * 100).cast("double")).alias("source_bytes"),
        F.when(F.col("event_id") % 10 != 0, F.floor(F.col("value") * 50).cast("double")).alias("destination_bytes"),
        F.when(kind == "error", "drop").when(kind == "signup", "alert").otherwise("allow").alias("event_action"),
        F.when(kind == "error", "tcp-rst-from-server").when(kind == "click", "aged-out").otherwise("tcp-fin").alias("event_reason"),
        F.when(kind == "error", "THREAT").otherwise("TRAFFIC").alias("event_name"),
        pick(TRANSPORTS, 3).alias("network_transport"),
    )


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machine names by address: every fifth user's is a virtual desktop's."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    ip = F.concat(F.lit("10.0."), (F.col("user_id") % 16).cast("string"), F.lit("."), (F.floor(F.col("user_id") / 16) % 250 + 1).cast("string"))
    name = F.concat(F.when(F.col("user_id") % 5 == 0, "VDI-").otherwise("server-"), F.col("user_id").cast("string"))
    return users.select(ip.alias("ip_address"), name.alias("machine_name"))
