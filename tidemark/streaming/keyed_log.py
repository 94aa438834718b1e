"""Sending messages to a keyed log once, although a batch may be tried again.

The protocol needs of a log only what a message broker offers: append, and reading
on from a position. Before a part is sent, its name and the log's end are written
down; after it, that it is done. A part that was begun and not done may have left
some of its messages behind: the tail from the noted position is read back, and only
what is not there yet is sent. Every message carries the part's name, its ``seq`` and
whether it is a tombstone, which together name it.

What is there is compared by a join on these names; nothing passes the driver but the
positions.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.sinks import keyed_order

# A message and its name.
MESSAGE = "topic string, key string, value string, part string, seq bigint, is_tombstone boolean"
NAME = ["topic", "part", "seq", "is_tombstone"]
TURNS = 2


class KeyedLog(Protocol):
    """An append-only log of keyed messages. Positions are text that only the log itself understands."""

    def end(self, spark: SparkSession, since: str | None) -> str:
        """The position behind all messages; ``since`` is an earlier one."""

    def append(self, messages: DataFrame) -> None:
        """Adds the messages, each key's in ``(seq, is_tombstone)`` order. May fail with some of them added."""

    def names(self, spark: SparkSession, since: str | None) -> DataFrame:
        """The names of the messages from a position on."""


@dataclass(frozen=True)
class FileLog:
    """A log in a folder: each append adds files, and a position is the number of appends that are whole.

    It stands in for a broker; ``read`` gives what a consumer would see.
    """

    path: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{MESSAGE}, append int").parquet(f"{self.path}/messages")

    def _appends(self, spark: SparkSession) -> int:
        try:
            last = self.read(spark).agg(F.max("append").alias("n")).first()["n"]
        except Exception as problem:  # the class differs between classic and remote sessions
            if "PATH_NOT_FOUND" not in str(problem):
                raise
            return 0
        return 0 if last is None else last + 1

    def end(self, spark: SparkSession, since: str | None) -> str:
        return str(self._appends(spark))

    def append(self, messages: DataFrame) -> None:
        number = self._appends(messages.sparkSession)
        names = [f.split()[0] for f in MESSAGE.split(", ")]
        keyed_order(messages).select(*names).write.mode("append").parquet(f"{self.path}/messages/append={number}")

    def names(self, spark: SparkSession, since: str | None) -> DataFrame:
        if not self._appends(spark):
            return spark.createDataFrame([], MESSAGE).select(*NAME)
        return self.read(spark).where(F.col("append") >= int(since or 0)).select(*NAME)


@dataclass(frozen=True)
class KafkaLog:
    """Topics of a broker. Names travel in headers, positions are offsets by topic and partition.

    Needs Spark's Kafka package. A broker adds what files cannot show: appends of
    several writers, retention (a position older than what is held fails the read),
    and delivery that repeats a message inside one attempt unless its producer is
    idempotent, which the options must ask for.
    """

    options: dict[str, str]

    def _headers(self, messages: DataFrame) -> DataFrame:
        texts = {"part": F.col("part"), "seq": F.col("seq").cast("string"), "tombstone": F.col("is_tombstone").cast("string")}
        pairs = [F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value")) for k, v in texts.items()]
        return messages.withColumn("headers", F.array(*pairs))

    def append(self, messages: DataFrame) -> None:
        framed = keyed_order(self._headers(messages)).select("topic", "key", "value", "headers")
        framed.write.format("kafka").options(**self.options).option("includeHeaders", "true").save()

    def _tail(self, spark: SparkSession, since: str | None) -> DataFrame:
        reader = spark.read.format("kafka").options(**self.options).option("includeHeaders", "true")
        return reader.option("startingOffsets", since or "earliest").option("endingOffsets", "latest").load()

    def end(self, spark: SparkSession, since: str | None) -> str:
        found = self._tail(spark, since).groupBy("topic", "partition").agg(F.max("offset").alias("last")).collect()
        places: dict[str, dict[str, int]] = json.loads(since) if since else {}
        for row in found:  # one for each topic and partition
            places.setdefault(row["topic"], {})[str(row["partition"])] = row["last"] + 1
        return json.dumps(places) if places else ""

    def names(self, spark: SparkSession, since: str | None) -> DataFrame:
        headers = F.map_from_entries("headers")
        own = self._tail(spark, since or None).where(F.col("headers").isNotNull()).select("topic", headers.alias("h"))
        text = {n: F.col("h")[n].cast("string") for n in ("part", "seq", "tombstone")}
        return own.select("topic", text["part"].alias("part"), text["seq"].cast("bigint").alias("seq"), text["tombstone"].cast("boolean").alias("is_tombstone"))


def _marks(spark: SparkSession, state: str) -> list:
    """The marks of the last parts, newest first: which part, where the log ended before it, whether it is done."""
    try:
        rows = spark.read.schema("part string, position string, done boolean, version bigint, turn int").parquet(f"{state}/sent").collect()
    except Exception as problem:  # the class differs between classic and remote sessions
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return []
    return sorted(rows, key=lambda r: -r["version"])


def _mark(spark: SparkSession, state: str, part: str, position: str, done: bool, version: int) -> None:
    row = spark.range(1).select(
        F.lit(part).alias("part"), F.lit(position).alias("position"), F.lit(done).alias("done"), F.lit(version).cast("bigint").alias("version")
    )
    row.coalesce(1).write.mode("overwrite").parquet(f"{state}/sent/turn={version % TURNS}")


def send_once(log: KeyedLog, messages: DataFrame, state: str, part: str) -> None:
    """Sends a part's messages (``topic, key, value, seq, is_tombstone``), whatever earlier attempts have left in the log."""
    spark = messages.sparkSession
    marks = _marks(spark, state)
    last = marks[0] if marks else None
    named = messages.withColumn("part", F.lit(part))
    if last is not None and last["part"] == part:
        if last["done"]:
            return
        position, version = last["position"], last["version"]
        there = log.names(spark, position).where(F.col("part") == part).distinct()
        named = named.join(there, NAME, "left_anti")
    else:
        position, version = log.end(spark, last["position"] if last else None), last["version"] + 1 if last else 0
        _mark(spark, state, part, position, False, version)
    log.append(named)
    _mark(spark, state, part, position, True, version + 1)
