"""Reading the raw change log, bounded or as a stream. The schema is always given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..logschema import raw_log_schema
from ..operators.offsets import begin_at
from ..operators.snapshot import snapshot_rows
from .observe import table_filter


def read_log(spark: SparkSession, path: str, table: StructType, fmt: str = "parquet") -> DataFrame:
    """All records of a log folder as they are."""
    return spark.read.format(fmt).schema(raw_log_schema(table)).load(path)


def snapshot_scan(spark: SparkSession, path: str, table: StructType, n: int, fmt: str = "parquet") -> DataFrame:
    """The bounded read: a log's records up to the snapshot commit of each of ``n`` partitions."""
    return snapshot_rows(read_log(spark, path, table, fmt), n)


def parse_records(records: DataFrame, table: StructType, value: str = "value") -> DataFrame:
    """Message values holding one raw log record each as JSON; bytes are base64 text in it."""
    parsed = F.from_json(F.col(value).cast("string"), raw_log_schema(table)).alias("record")
    return records.select(parsed).select("record.*")


def change_stream(
    spark: SparkSession,
    path: str | None = None,
    table: StructType | None = None,
    *,
    kafka: dict[str, str] | None = None,
    offsets: list[str | None] | None = None,
    fmt: str = "parquet",
    max_files: int | None = None,
    max_records: int | None = None,
    max_bytes: int | None = None,
    glob: str | None = None,
    of: tuple[str, str] | None = None,
) -> DataFrame:
    """The unbounded read, from a vector of offsets.

    ``of`` names a database and table where the log holds several: records then carry
    their database in a column ``db``, and those of other tables are left out.

    A folder is read file by file, at most ``max_files`` or files of ``max_bytes``
    per batch; Kafka messages (see :func:`parse_records`) at most ``max_records``.
    """
    if kafka is not None:
        reader = spark.readStream.format("kafka").options(**kafka).option("failOnDataLoss", "true")
        if max_records:
            reader = reader.option("maxOffsetsPerTrigger", str(max_records))
        log = parse_records(reader.load(), table)
    else:
        schema = raw_log_schema(table)
        if of is not None:
            schema = StructType([*schema.fields, StructField("db", StringType())])
        reader = spark.readStream.format(fmt).schema(schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", str(max_files))
        elif max_bytes:
            reader = reader.option("maxBytesPerTrigger", str(max_bytes))
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        log = reader.load(path)
        if of is not None:
            log = table_filter(log, *of).drop("db")
    return begin_at(log, offsets) if offsets else log
