"""Change logs derived from the given tables, each with the same expressions as its SQL twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from ..config import CdcConfig
from ..logschema import BEGIN_SNAPSHOT, COMMIT_SNAPSHOT

PARTITIONS = 8
DB, TABLE, PREFIX = "shop", "user_events", "app"

# The given tables are small; buckets of this size still spread them over all cores.
SMALL_BUCKETS = 1 << 13
EVENTS_CONFIG = CdcConfig(topic_prefix=PREFIX, db=DB, table=TABLE, partitions=PARTITIONS, bucket_rows=SMALL_BUCKETS)
CUSTOMER_CONFIG = CdcConfig(topic_prefix=PREFIX, db=DB, table="customer", partitions=PARTITIONS, bucket_rows=SMALL_BUCKETS)

# Schema of the captured tables, with their source types.
EVENTS_TABLE = StructType(
    [
        StructField("user_id", LongType(), False, {"type": "BIGINT", "primary_key": True}),
        StructField("event_type", StringType(), True, {"type": "VARCHAR(20)", "length": 20}),
        StructField("value", DoubleType(), True, {"type": "DOUBLE"}),
        StructField("props", StringType(), True, {"type": "JSON"}),
        StructField("ts", TimestampNTZType(), True, {"type": "DATETIME(6)", "length": 26}),
    ]
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex_bytes(c: Column, digits: int) -> Column:
    """A number as that many hex digits, in bytes."""
    return F.unhex(F.lpad(F.hex(c), digits, "0"))


def _log_columns(seq: Column, pid: Column, kind: Column, internal: Column, table: str) -> list[Column]:
    offset = F.lpad(F.hex(seq), 48, "0")
    return [
        seq.alias("seq"),
        F.unhex(offset).alias("Offset"),
        pid.cast("int").alias("PartitionId"),
        kind.alias("Type"),
        F.lit(table).alias("Table"),
        F.unhex(F.concat(F.lit("f" * 16), offset, F.lit("0" * 16))).alias("TxId"),
        F.lit("1").alias("TxPartitions"),
        hex_bytes(internal, 24).alias("InternalId"),
    ]


def events_to_log(events: DataFrame) -> DataFrame:
    """The ``events`` table, bounded or streamed, as a raw change log."""
    kind = (
        F.when(F.col("event_type") == "signup", "Insert")
        .when(F.col("event_type").isin("click", "purchase"), "Update")
        .when(F.col("event_type") == "error", "Delete")
        .otherwise("CommitTransaction")
    )
    return events.select(
        *_log_columns(F.col("event_id"), F.col("user_id") % PARTITIONS, kind, F.col("user_id"), TABLE),
        "user_id",
        "event_type",
        "value",
        "props",
        "ts",
    )


def events_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_log(load(spark, sf_dir, "events"))


def customer_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as a bounded snapshot log; every partition commits at about three quarters."""
    customer = load(spark, sf_dir, "customer")
    cut = customer.agg((F.call_function("div", F.call_function("div", F.count(F.lit(1)), F.lit(8)) * 3, F.lit(4))).alias("c"))
    pid = F.col("c_custkey") % PARTITIONS
    rn = F.call_function("div", F.col("c_custkey"), F.lit(8))
    rows = customer.select(
        *_log_columns((rn + 1) * 16 + pid * 2 + 1, pid, F.lit("Insert"), F.col("c_custkey"), "customer"), *customer.columns
    )
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in customer.schema.fields]
    partitions = spark.range(PARTITIONS).withColumnRenamed("id", "p")
    begins = partitions.select(*_log_columns(F.col("p") * 2 + 1, F.col("p"), F.lit(BEGIN_SNAPSHOT), F.lit(0), "customer"), *none)
    commits = partitions.withColumn("rn", cut.scalar() + F.col("p")).select(
        *_log_columns((F.col("rn") + 1) * 16 + F.col("p") * 2, F.col("p"), F.lit(COMMIT_SNAPSHOT), F.lit(0), "customer"), *none
    )
    return rows.unionByName(begins).unionByName(commits)


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of :func:`customer_snapshot` again, as the change log that goes on after it."""
    return customer_snapshot(spark, sf_dir).where(F.col("Type") == "Insert")


def offset_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets by kind and partition, as the server's catalog lists them."""
    kind = F.when(F.col("event_type") == "signup", "snapshot_begin").when(F.col("event_type") == "view", "log_tail")
    return load(spark, sf_dir, "events").select(
        (F.col("user_id") % PARTITIONS).cast("int").alias("ORDINAL"),
        hex_bytes(F.col("event_id"), 48).alias("OFFSET"),
        # Other kinds, which the operators leave out themselves.
        F.coalesce(kind, F.col("event_type")).alias("OFFSET_TYPE"),
    )


# The SQL twins, as common table expressions.
EVENTS_SQL = """
log AS (
  SELECT event_id AS seq,
         lpad(lower(hex(event_id)), 48, '0') AS off,
         user_id % 8 AS pid,
         CASE WHEN event_type = 'signup' THEN 'Insert'
              WHEN event_type IN ('click', 'purchase') THEN 'Update'
              WHEN event_type = 'error' THEN 'Delete'
              ELSE 'CommitTransaction' END AS kind,
         'ffffffffffffffff' || lpad(lower(hex(event_id)), 48, '0') || '0000000000000000' AS tx,
         lpad(lower(hex(user_id)), 24, '0') AS iid,
         user_id, event_type, value, props, ts, epoch_us(ts) // 1000 AS ms, epoch_us(ts) AS us
  FROM events),
ev AS (
  SELECT *, CASE kind WHEN 'Insert' THEN 'c' WHEN 'Update' THEN 'u' ELSE 'd' END AS op
  FROM log WHERE kind IN ('Insert', 'Update', 'Delete'))
"""

_SLOTS = ", ".join(
    f"coalesce(last_value(CASE WHEN pid = {i} THEN off END IGNORE NULLS) OVER w, 'null')" for i in range(PARTITIONS)
)
VECTOR_SQL = f"""
vec AS (
  SELECT *, concat_ws(',', {_SLOTS}) AS offsets
  FROM ev WINDOW w AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""

SNAPSHOT_SQL = """
base AS (SELECT *, c_custkey % 8 AS pid, c_custkey // 8 AS rn FROM customer),
cut AS (SELECT ((count(*) // 8) * 3) // 4 AS c FROM customer),
commits AS (SELECT p AS pid, (c + p + 1) * 16 + p * 2 AS commit_seq FROM cut, range(8) t(p)),
begins AS (SELECT p AS pid, p * 2 + 1 AS begin_seq FROM range(8) t(p)),
slog AS (
  SELECT *, (rn + 1) * 16 + pid * 2 + 1 AS seq,
         lpad(lower(hex((rn + 1) * 16 + pid * 2 + 1)), 48, '0') AS off
  FROM base),
snap AS (SELECT slog.* FROM slog JOIN commits USING (pid) WHERE seq < commit_seq)
"""
