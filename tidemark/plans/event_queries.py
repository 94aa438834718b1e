"""Queries over streamed change logs: envelope, routing, offsets, state."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import events as facts
from ..functions import offsets as fo
from ..operators import columns as oc
from ..operators import envelope as oe
from ..operators import metrics as om
from ..operators import offsets as oo
from ..operators import sinks as os_
from ..operators import state as ost
from ..session import fresh_path
from ..sources import catalog, observe as so
from ..streaming import start as st
from ..hooks import Hooks
from ..logschema import META_COLUMNS
from ..operators.snapshot import snapshot_flags
from . import fixtures as fx
from .fixtures import DB, EVENTS_CONFIG, EVENTS_SQL, EVENTS_TABLE, PARTITIONS, PREFIX, TABLE, VECTOR_SQL
from .pipeline import cdc_events, cdc_records
from .registry import query

E = f"WITH {EVENTS_SQL} "
V = f"WITH {EVENTS_SQL}, {VECTOR_SQL} "


def ts() -> Column:
    """Change time of the events table, in place of the clock."""
    return F.unix_millis(F.col("ts").cast("timestamp"))


def event_rows(spark, sf_dir) -> DataFrame:
    """The raw log's data records with their operation."""
    return oe.map_op(oe.drop_markers(fx.events_changelog(spark, sf_dir)))


def events_of(spark, sf_dir, config=EVENTS_CONFIG, **options) -> DataFrame:
    return cdc_events(fx.events_changelog(spark, sf_dir), EVENTS_TABLE, config, ts_ms=ts(), **options)


def vector_rows(spark, sf_dir) -> DataFrame:
    return oo.with_offset_vector(event_rows(spark, sf_dir), PARTITIONS, bucket_rows=EVENTS_CONFIG.bucket_rows)


def _no_before(side: str = "before") -> Column:
    return F.col(side).isNull()


@query(
    "cdc_events",
    V
    + f"""SELECT seq, '{PREFIX}.{DB}.{TABLE}' AS topic, user_id AS key_user_id, op,
      CASE WHEN op <> 'd' THEN user_id END AS after_user_id,
      CASE WHEN op <> 'd' THEN event_type END AS after_event_type,
      CASE WHEN op <> 'd' THEN value END AS after_value,
      CASE WHEN op <> 'd' THEN props END AS after_props,
      CASE WHEN op <> 'd' THEN us END AS after_ts,
      true AS before_is_null, ms AS ts_ms, 'false' AS snapshot, '{DB}' AS db, '{TABLE}' AS tbl,
      tx AS tx_id, pid::INTEGER AS partition_id, offsets FROM vec""",
)
def cdc_events_query(spark, sf_dir):
    return flat_events(events_of(spark, sf_dir))


def flat_events(events: DataFrame) -> DataFrame:
    after = [F.col(f"after.{c}").alias(f"after_{c}") for c in EVENTS_TABLE.names]
    return events.select(
        "seq",
        "topic",
        F.col("key.user_id").alias("key_user_id"),
        "op",
        *after,
        _no_before().alias("before_is_null"),
        "ts_ms",
        "source.snapshot",
        "source.db",
        F.col("source.table").alias("tbl"),
        F.col("source.txId").alias("tx_id"),
        F.col("source.partitionId").alias("partition_id"),
        fo.format_offsets("source.offsets").alias("offsets"),
    )


@query("split_meta", E + "SELECT seq, pid::INTEGER AS partition_id, kind, user_id, event_type, value FROM log")
def split_meta_query(spark, sf_dir):
    parts = oe.split_meta(fx.events_changelog(spark, sf_dir))
    return parts.select(
        "meta.seq",
        F.col("meta.PartitionId").alias("partition_id"),
        F.col("meta.Type").alias("kind"),
        "row.user_id",
        "row.event_type",
        "row.value",
    )


@query("map_op", E + "SELECT seq, kind, op FROM ev")
def map_op_query(spark, sf_dir):
    return event_rows(spark, sf_dir).select("seq", F.col("Type").alias("kind"), "op")


@query("drop_markers", E + "SELECT seq, kind, user_id FROM ev")
def drop_markers_query(spark, sf_dir):
    return oe.drop_markers(fx.events_changelog(spark, sf_dir)).select("seq", F.col("Type").alias("kind"), "user_id")


@query("skip_operations", V + "SELECT seq, op, offsets FROM vec WHERE op <> 'c'")
def skip_operations_query(spark, sf_dir):
    events = events_of(spark, sf_dir, replace(EVENTS_CONFIG, skipped_operations="c,t"))
    return events.select("seq", "op", facts.event_position().alias("offsets"))


LINES_SQL = """SELECT l_orderkey AS key_orderkey, l_linenumber AS key_linenumber,
  CASE l_returnflag WHEN 'N' THEN 'c' WHEN 'A' THEN 'u' WHEN 'R' THEN 'd' END AS op, l_quantity AS quantity
  FROM lineitem"""


@query("event_key_composite", LINES_SQL)
def event_key_composite_query(spark, sf_dir):
    flag = F.col("l_returnflag")
    kind = F.when(flag == "N", "Insert").when(flag == "A", "Update").when(flag == "R", "Delete")
    log = fx.load(spark, sf_dir, "lineitem").withColumn("Type", kind)
    keyed = oe.event_key(oe.map_op(log), ["l_orderkey", "l_linenumber"])
    return keyed.select(
        F.col("key.l_orderkey").alias("key_orderkey"),
        F.col("key.l_linenumber").alias("key_linenumber"),
        "op",
        F.col("l_quantity").alias("quantity"),
    )


@query("event_key_internal_id", E + "SELECT seq, op, iid AS internal_id FROM ev")
def event_key_internal_id_query(spark, sf_dir):
    return oe.event_key(event_rows(spark, sf_dir)).select("seq", "op", F.col("key.internalId").alias("internal_id"))


@query(
    "populate_internal_id",
    E
    + """SELECT seq, iid AS key_id, iid AS after_id, 6 AS n_fields,
      '{"user_id":' || user_id || ',"event_type":"' || event_type || '","internalId":"' || iid || '"}' AS tail
      FROM ev""",
)
def populate_internal_id_query(spark, sf_dir):
    rows = oe.event_key(event_rows(spark, sf_dir))
    rows = oe.with_internal_id(rows.withColumn("after", F.struct(*EVENTS_TABLE.names)), populate=True)
    return rows.select(
        "seq",
        F.col("key.internalId").alias("key_id"),
        F.col("after.internalId").alias("after_id"),
        F.size(F.map_keys(F.from_json(F.to_json("after", {"ignoreNullFields": "false"}), "map<string,string>"))).alias(
            "n_fields"
        ),
        F.to_json(F.col("after").dropFields("value", "props", "ts")).alias("tail"),
    )


@query(
    "create_update_events",
    E
    + """SELECT seq, op, true AS before_is_null, user_id, event_type, value FROM ev WHERE op <> 'd'""",
)
def create_update_events_query(spark, sf_dir):
    rows = event_rows(spark, sf_dir).where("op <> 'd'").withColumn("row", F.struct(*EVENTS_TABLE.names))
    before, after = oe.create_event(F.col("row"))
    old, new = oe.update_event(F.col("row"))
    created = F.col("op") == "c"
    return rows.select(
        "seq",
        "op",
        F.when(created, before).otherwise(old).alias("before"),
        F.when(created, after).otherwise(new).alias("after"),
    ).select("seq", "op", _no_before().alias("before_is_null"), "after.user_id", "after.event_type", "after.value")


@query(
    "delete_events",
    E + "SELECT seq, user_id AS key_user_id, true AS before_is_null, true AS after_is_null, op FROM ev WHERE op = 'd'",
)
def delete_events_query(spark, sf_dir):
    rows = oe.event_key(event_rows(spark, sf_dir).where("op = 'd'"), ["user_id"])
    before, after = oe.delete_event(F.struct(*EVENTS_TABLE.names))
    return rows.select(
        "seq",
        F.col("key.user_id").alias("key_user_id"),
        before.isNull().alias("before_is_null"),
        after.isNull().alias("after_is_null"),
        "op",
    )


@query(
    "tombstones",
    E
    + """SELECT seq, user_id AS key_user_id, false AS is_tombstone, op FROM ev
      UNION ALL SELECT seq, user_id, true, NULL FROM ev WHERE op = 'd'""",
)
def tombstones_query(spark, sf_dir):
    records = cdc_records(events_of(spark, sf_dir), EVENTS_CONFIG)
    return records.select("seq", F.col("key.user_id").alias("key_user_id"), "is_tombstone", F.col("value.op").alias("op"))


@query(
    "source_struct",
    E
    + f"""SELECT seq, '0.1.0' AS version, 'tidemark' AS connector, '{PREFIX}' AS name, ms AS ts_ms, 'false' AS snapshot,
      '{DB}' AS db, true AS sequence_is_null, '{TABLE}' AS tbl, tx AS tx_id, pid::INTEGER AS partition_id, off AS offsets
      FROM ev""",
)
def source_struct_query(spark, sf_dir):
    own = F.array(fo.to_hex("Offset"))
    source = oe.source_struct(EVENTS_CONFIG, ts_ms=ts(), offsets=own, strict=True)
    return event_rows(spark, sf_dir).select("seq", source.alias("s")).select(
        "seq",
        "s.version",
        "s.connector",
        "s.name",
        "s.ts_ms",
        "s.snapshot",
        "s.db",
        F.col("s.sequence").isNull().alias("sequence_is_null"),
        F.col("s.table").alias("tbl"),
        F.col("s.txId").alias("tx_id"),
        F.col("s.partitionId").alias("partition_id"),
        fo.format_offsets("s.offsets").alias("offsets"),
    )


@query(
    "event_metadata",
    V + "SELECT seq, ms AS event_ms, tx AS tx_id, offsets AS position FROM vec",
)
def event_metadata_query(spark, sf_dir):
    return events_of(spark, sf_dir).select(
        "seq",
        F.unix_millis(facts.event_timestamp()).alias("event_ms"),
        facts.event_txid().alias("tx_id"),
        facts.event_position().alias("position"),
    )


@query(
    "topic_route",
    """SELECT c_custkey, 'app.shop.' || c_mktsegment AS topic, 'app_shop_' || c_mktsegment AS underscored FROM customer""",
)
def topic_route_query(spark, sf_dir):
    table = F.col("c_mktsegment")
    return fx.load(spark, sf_dir, "customer").select(
        "c_custkey",
        os_.topic_name(PREFIX, DB, table).alias("topic"),
        os_.topic_name(PREFIX, DB, table, "_").alias("underscored"),
    )


@query(
    "topic_route_unicode",
    """SELECT c_custkey, 'my_u005fapp.shop.' || c_mktsegment || '_u005f' || c_nationkey AS topic FROM customer""",
)
def topic_route_unicode_query(spark, sf_dir):
    table = F.concat_ws("_", "c_mktsegment", F.col("c_nationkey").cast("string"))
    return fx.load(spark, sf_dir, "customer").select(
        "c_custkey", os_.topic_name("my_app", DB, table, strategy="unicode").alias("topic")
    )


def _field(kind: str, name: str, optional: bool = True) -> str:
    return f'{{"type":"{kind}","optional":{str(optional).lower()},"field":"{name}"}}'


_ROW = [_field("int64", "user_id", False), _field("string", "event_type"), _field("double", "value"), _field("string", "props"), _field("int64", "ts")]
_SOURCE = [
    *[_field("string", n, False) for n in ("version", "connector", "name")],
    _field("int64", "ts_ms", False),
    _field("string", "snapshot"),
    _field("string", "db", False),
    _field("string", "sequence"),
    *[_field("string", n, False) for n in ("table", "txId")],
    _field("int32", "partitionId", False),
    '{"type":"array","items":{"type":"string","optional":true},"optional":false,"field":"offsets"}',
]
_TRANSACTION = [_field("string", "id"), _field("int64", "total_order"), _field("int64", "data_collection_order")]


def _struct(fields: list[str], name: str, optional: bool = True) -> str:
    return f'{{"type":"struct","fields":[{",".join(fields)}],"optional":{str(optional).lower()},"field":"{name}"}}'


MESSAGE_SCHEMA = ",".join(
    [
        _struct(_ROW, "before"),
        _struct(_ROW, "after"),
        _struct(_SOURCE, "source", False),
        _field("string", "op", False),
        _field("int64", "ts_ms"),
        _struct(_TRANSACTION, "transaction"),
    ]
)


@query(
    "messages_json",
    V
    + f"""SELECT seq,
      '{{"schema":{{"type":"struct","fields":[{{"type":"int64","optional":false,"field":"user_id"}}],"optional":false,"name":"app.shop.user_events.Key"}},"payload":{{"user_id":' || user_id || '}}}}' AS key,
      '{{"schema":{{"type":"struct","fields":[{MESSAGE_SCHEMA}],"optional":false,"name":"app.shop.user_events.Envelope"}},"payload":'
      || '{{"before":null,"after":' || CASE WHEN op = 'd' THEN 'null' ELSE
        '{{"user_id":' || user_id || ',"event_type":"' || event_type || '","value":' || value || ',"props":' || to_json(props) || ',"ts":' || us || '}}' END
      || ',"source":{{"version":"0.1.0","connector":"tidemark","name":"{PREFIX}","ts_ms":' || ms || ',"snapshot":"false","db":"{DB}","sequence":null,"table":"{TABLE}","txId":"'
      || tx || '","partitionId":' || pid || ',"offsets":['
      || array_to_string(list_transform(string_split(offsets, ','), lambda o: CASE WHEN o = 'null' THEN o ELSE '"' || o || '"' END), ',')
      || ']}},"op":"' || op || '","ts_ms":' || ms || ',"transaction":null}}}}' AS value FROM vec""",
)
def messages_json_query(spark, sf_dir):
    return os_.to_messages(events_of(spark, sf_dir), f"{PREFIX}.{DB}.{TABLE}", EVENTS_TABLE).select("seq", "key", "value")


@query(
    "write_events",
    V
    + """SELECT 'app.shop.user_events' AS topic, seq, user_id AS key_user_id, op, offsets,
        CASE WHEN op <> 'd' THEN event_type END AS after_event_type FROM vec
      UNION ALL SELECT 'app.shop.user_events', seq, user_id, 'tombstone', NULL, NULL FROM vec WHERE op = 'd'""",
)
def write_events_query(spark, sf_dir):
    path = fresh_path(spark, "write-events")
    os_.write_events(cdc_records(events_of(spark, sf_dir), EVENTS_CONFIG), path)
    return spark.read.parquet(path).select(
        "topic",
        "seq",
        F.col("key.user_id").alias("key_user_id"),
        F.coalesce("value.op", F.lit("tombstone")).alias("op"),
        fo.format_offsets("value.source.offsets").alias("offsets"),
        F.col("value.after.event_type").alias("after_event_type"),
    )


@query(
    "observe_where",
    E + "SELECT seq, pid::INTEGER AS partition_id, kind, user_id, value FROM log WHERE value > 50 AND pid < 4",
)
def observe_where_query(spark, sf_dir):
    scan = so.observe(
        fx.events_changelog(spark, sf_dir), ["user_id", "value"], [TABLE], where="value > 50 AND PartitionId < 4"
    )
    return scan.select("seq", F.col("PartitionId").alias("partition_id"), F.col("Type").alias("kind"), "user_id", "value")


@query(
    "observe_json",
    E
    + f"""SELECT '{{"seq":' || seq || ',"Offset":"' || to_base64(unhex(off)) || '","PartitionId":' || pid || ',"Type":"' || kind
      || '","Table":"{TABLE}","TxId":"' || to_base64(unhex(tx)) || '","TxPartitions":"1","InternalId":"' || to_base64(unhex(iid))
      || '","user_id":' || user_id || ',"event_type":"' || event_type || '"}}' AS record FROM log""",
)
def observe_json_query(spark, sf_dir):
    return so.observe(fx.events_changelog(spark, sf_dir), ["user_id", "event_type"], fmt="json")


# A start vector with a null element; any data has records on both sides of it.
START: list[str | None] = [format(n, "048x") if n is not None else None for n in (100, None, 200, 50, 400, 10, None, 333)]
_BOUND = " OR ".join(
    f"(pid = {i} AND off > '{o}')" if o else f"pid = {i}" for i, o in enumerate(START)
)


@query("begin_at", E + f"SELECT seq, pid::INTEGER AS partition_id, off FROM log WHERE {_BOUND}")
def begin_at_query(spark, sf_dir):
    return oo.begin_at(fx.events_changelog(spark, sf_dir), START).select(
        "seq", F.col("PartitionId").alias("partition_id"), fo.to_hex("Offset").alias("off")
    )


@query(
    "table_filter",
    """SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus = 'O'""",
)
def table_filter_query(spark, sf_dir):
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    log = fx.load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(priority.isin("1-URGENT", "5-LOW"), "shop")
        .when(priority == "2-HIGH", "Shop")
        .when(priority == "3-MEDIUM", "INFORMATION_SCHEMA")
        .alias("db"),
        F.when(status == "O", "orders").when(status == "F", "Orders").otherwise("orders_p").alias("Table"),
    )
    return so.table_filter(log, "shop", "orders").select("o_orderkey")


@query("offset_vector", V + "SELECT seq, pid::INTEGER AS partition_id, offsets FROM vec")
def offset_vector_query(spark, sf_dir):
    return vector_rows(spark, sf_dir).select(
        "seq", F.col("PartitionId").alias("partition_id"), fo.format_offsets("offsets").alias("offsets")
    )


def _wide_sql(n: int) -> str:
    slot = "coalesce(last_value(CASE WHEN user_id % {n} = {i} THEN off END IGNORE NULLS) OVER w, 'null')"
    slots = ", ".join(slot.format(n=n, i=i) for i in range(n))
    return (
        E
        + f"""SELECT seq, (user_id % {n})::INTEGER AS partition_id, md5(concat_ws(',', {slots})) AS offsets_md5
      FROM ev WINDOW w AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    )


def _wide_vector(spark, sf_dir, n: int):
    rows = event_rows(spark, sf_dir).withColumn("PartitionId", (F.col("user_id") % n).cast("int"))
    placed = oo.with_offset_vector(rows, n, bucket_rows=EVENTS_CONFIG.bucket_rows)
    return placed.select("seq", F.col("PartitionId").alias("partition_id"), F.md5(fo.format_offsets("offsets")).alias("offsets_md5"))


@query("offset_vector_64", _wide_sql(64))
def offset_vector_64_query(spark, sf_dir):
    return _wide_vector(spark, sf_dir, 64)


@query("offset_vector_256", _wide_sql(256))
def offset_vector_256_query(spark, sf_dir):
    return _wide_vector(spark, sf_dir, 256)


# Arrival numbers far apart and unevenly so: the cube of the given ones, spread over most of the range of a BIGINT.
SPARSE = "seq * seq * seq * 4000 - 9000000000000"


def _sparse_sql(n: int) -> str:
    return _wide_sql(n).replace("SELECT seq,", f"SELECT {SPARSE} AS seq,")


def _sparse_vector(spark, sf_dir, n: int):
    rows = event_rows(spark, sf_dir).withColumn("PartitionId", (F.col("user_id") % n).cast("int")).withColumn("seq", F.expr(SPARSE))
    placed = oo.with_offset_vector(rows, n, bucket_rows=EVENTS_CONFIG.bucket_rows)
    return placed.select("seq", F.col("PartitionId").alias("partition_id"), F.md5(fo.format_offsets("offsets")).alias("offsets_md5"))


@query("offset_vector_sparse", _sparse_sql(8))
def offset_vector_sparse_query(spark, sf_dir):
    return _sparse_vector(spark, sf_dir, 8)


@query("offset_vector_sparse_64", _sparse_sql(64))
def offset_vector_sparse_64_query(spark, sf_dir):
    return _sparse_vector(spark, sf_dir, 64)


_STARTED = ", ".join(
    f"coalesce(last_value(CASE WHEN pid = {i} THEN off END IGNORE NULLS) OVER w, {repr(o or 'null')})"
    for i, o in enumerate(START)
)


@query(
    "offset_vector_resumed",
    E
    + f"""SELECT seq, concat_ws(',', {_STARTED}) AS offsets FROM ev WHERE {_BOUND}
      WINDOW w AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def offset_vector_resumed_query(spark, sf_dir):
    rows = oo.begin_at(event_rows(spark, sf_dir), START)
    return oo.with_offset_vector(rows, PARTITIONS, START, bucket_rows=EVENTS_CONFIG.bucket_rows).select(
        "seq", fo.format_offsets("offsets").alias("offsets")
    )


@query(
    "offset_format_parse",
    V
    + """SELECT seq, offsets AS again, len(string_split(offsets, ',')) AS n_elements,
      len(list_filter(string_split(offsets, ','), lambda o: o = 'null')) AS n_null, false AS all_null FROM vec""",
)
def offset_format_parse_query(spark, sf_dir):
    text = vector_rows(spark, sf_dir).select("seq", fo.format_offsets("offsets").alias("text"))
    return text.withColumn("parsed", fo.parse_offsets("text")).select(
        "seq",
        fo.format_offsets("parsed").alias("again"),
        F.size("parsed").cast("bigint").alias("n_elements"),
        F.size(F.filter("parsed", lambda o: o.isNull())).cast("bigint").alias("n_null"),
        fo.no_offset("parsed").alias("all_null"),
    )


@query(
    "offset_validate",
    E
    + """SELECT seq, array_to_string(list_filter(string_split(off || ',NULL,' || event_type || ',' || upper(iid) || ',x' || user_id, ','),
      lambda e: NOT regexp_full_match(e, '[0-9a-fA-F]+') AND lower(e) <> 'null'), '|') AS invalid FROM log""",
)
def offset_validate_query(spark, sf_dir):
    text = F.concat_ws(
        ",",
        fo.to_hex("Offset"),
        F.lit("NULL"),
        "event_type",
        F.hex("InternalId"),
        F.concat(F.lit("x"), F.col("user_id").cast("string")),
    )
    return fx.events_changelog(spark, sf_dir).select("seq", F.array_join(fo.invalid_offsets(text), "|").alias("invalid"))


CATALOG_SQL = """
cat AS (SELECT (user_id % 8) AS ord, lpad(lower(hex(event_id)), 48, '0') AS off,
  CASE event_type WHEN 'signup' THEN 'snapshot_begin' ELSE 'log_tail' END AS kind
  FROM events WHERE event_type IN ('signup', 'view')),
oldest AS (SELECT ord, min(off) AS off FROM cat WHERE kind = 'snapshot_begin' GROUP BY ord),
tails AS (SELECT ord, max(off) AS off FROM cat WHERE kind = 'log_tail' GROUP BY ord)
"""


def _dense_sql(name: str) -> str:
    return (
        f"(SELECT string_agg(coalesce(t.off, 'null'), ',' ORDER BY p) FROM range(8) r(p) LEFT JOIN {name} t ON t.ord = p)"
    )


@query("oldest_snapshot_begin", f"WITH {CATALOG_SQL} SELECT {_dense_sql('oldest')} AS offsets")
def oldest_snapshot_begin_query(spark, sf_dir):
    found = oo.oldest_snapshot_begin(fx.offset_catalog(spark, sf_dir), PARTITIONS)
    return found.select(fo.format_offsets("offsets").alias("offsets"))


@query("log_tails", f"WITH {CATALOG_SQL} SELECT {_dense_sql('tails')} AS offsets")
def log_tails_query(spark, sf_dir):
    found = oo.log_tails(fx.offset_catalog(spark, sf_dir), PARTITIONS)
    return found.select(fo.format_offsets("offsets").alias("offsets"))


@query(
    "stale_check",
    f"""WITH {EVENTS_SQL}, {VECTOR_SQL}, {CATALOG_SQL}, o AS (SELECT string_split({_dense_sql('oldest')}, ',') AS v)
      SELECT seq, len(list_filter(range(1, 9), lambda i: string_split(offsets, ',')[i] <> 'null' AND v[i] <> 'null'
        AND v[i] > string_split(offsets, ',')[i])) > 0 AS stale FROM vec, o""",
)
def stale_check_query(spark, sf_dir):
    oldest = oo.oldest_snapshot_begin(fx.offset_catalog(spark, sf_dir), PARTITIONS)
    rows = vector_rows(spark, sf_dir).withColumn("oldest", oldest.scalar())
    return rows.select("seq", oo.vectors_stale(F.col("offsets"), F.col("oldest")).alias("stale"))


@query(
    "stale_tables",
    f"""WITH {CATALOG_SQL} SELECT count(*) FILTER (WHERE t.off IS NOT NULL AND o.off IS NOT NULL AND t.off > o.off) > 0 AS stale
      FROM range(8) r(p) LEFT JOIN tails t ON t.ord = p LEFT JOIN oldest o ON o.ord = p""",
)
def stale_tables_query(spark, sf_dir):
    offsets = fx.offset_catalog(spark, sf_dir)
    return oo.is_stale(oo.oldest_snapshot_begin(offsets, PARTITIONS), oo.log_tails(offsets, PARTITIONS))


@query(
    "plan_start",
    """WITH cases AS (
        SELECT o_orderkey,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'initial' WHEN '2-HIGH' THEN 'initial_only' WHEN '3-MEDIUM' THEN 'no_data'
            WHEN '4-NOT SPECIFIED' THEN 'when_needed' ELSE 'initial' END AS mode,
          o_orderkey % 2 = 0 AS stored, o_orderstatus <> 'P' AS finished, o_custkey % 3 = 0 AS stale,
          o_orderkey % 5 = 0 AS config, o_custkey % 7 = 0 AS all_null FROM orders),
      kept AS (SELECT *, stored AND NOT (stale AND mode = 'when_needed') AS has FROM cases)
      SELECT o_orderkey, mode,
        CASE WHEN mode = 'no_data' THEN false WHEN has AND finished THEN false ELSE true END AS snapshot,
        mode <> 'initial_only' AS stream,
        CASE WHEN mode <> 'no_data' AND NOT has THEN 'none'
             WHEN mode <> 'no_data' AND NOT finished THEN 'stored'
             WHEN config THEN 'config'
             WHEN NOT has OR all_null THEN 'tails'
             ELSE 'stored' END AS start,
        CASE WHEN NOT (has AND stale) THEN false
             WHEN mode <> 'no_data' AND NOT finished THEN true
             WHEN config OR all_null OR mode = 'initial_only' THEN false
             ELSE true END AS fail
      FROM kept""",
)
def plan_start_query(spark, sf_dir):
    priority = F.col("o_orderpriority")
    mode = (
        F.when(priority == "1-URGENT", "initial")
        .when(priority == "2-HIGH", " INITIAL_ONLY ")
        .when(priority == "3-MEDIUM", "no_data")
        .when(priority == "4-NOT SPECIFIED", "When_Needed")
        .otherwise("bogus")
    )
    decided = fx.load(spark, sf_dir, "orders").select(
        "o_orderkey",
        st.normal_mode(mode).alias("mode"),
        st.start_decision(
            mode,
            F.col("o_orderkey") % 2 == 0,
            F.col("o_orderstatus") != "P",
            F.col("o_custkey") % 3 == 0,
            F.col("o_orderkey") % 5 == 0,
            F.col("o_custkey") % 7 == 0,
        ).alias("d"),
    )
    return decided.select("o_orderkey", "mode", "d.*")


@query(
    "stored_offsets",
    V
    + """SELECT seq, tx AS tx_id, offsets AS stored_text, offsets AS again, pid::INTEGER AS partition_id,
      CASE WHEN seq % 2 = 0 THEN true END AS stored_snapshot, seq % 2 = 0 AS snapshot, seq % 3 = 0 AS completed,
      seq % 2 = 0 AND seq % 3 <> 0 AS running,
      CASE WHEN seq % 2 = 0 AND seq % 3 <> 0 THEN 'true' ELSE 'false' END AS marker FROM vec""",
)
def stored_offsets_query(spark, sf_dir):
    stored = st.stored_offset(
        fo.to_hex("TxId"), F.col("offsets"), F.col("PartitionId"), F.col("seq") % 2 == 0, F.col("seq") % 3 == 0
    )
    rows = vector_rows(spark, sf_dir).select("seq", stored.alias("s"))
    rows = rows.withColumn("l", st.loaded_offset(F.col("s")))
    rows = rows.withColumn("f", snapshot_flags(F.col("l.snapshot"), F.col("l.snapshot_completed")))
    return rows.select(
        "seq",
        F.col("l.txId").alias("tx_id"),
        F.col("s.offsets").alias("stored_text"),
        fo.format_offsets("l.offsets").alias("again"),
        F.col("l.partitionId").alias("partition_id"),
        F.col("s.snapshot").alias("stored_snapshot"),
        "l.snapshot",
        F.col("l.snapshot_completed").alias("completed"),
        "f.running",
        "f.marker",
    )


@query("partition_count", "SELECT coalesce(max(user_id % 8 + 1), 1)::INTEGER AS partitions FROM events")
def partition_count_query(spark, sf_dir):
    known = fx.load(spark, sf_dir, "events").select((F.col("user_id") % PARTITIONS + 1).alias("num_partitions"))
    return catalog.partition_count(known)


COUNTERS_SQL = """count(*) AS total_events, count(*) FILTER (WHERE op = 'c') AS total_creates,
  count(*) FILTER (WHERE op = 'u') AS total_updates, count(*) FILTER (WHERE op = 'd') AS total_deletes"""


@query("event_counters", E + f"SELECT {COUNTERS_SQL} FROM ev")
def event_counters_query(spark, sf_dir):
    return om.event_counters(event_rows(spark, sf_dir))


@query("metric_tags", E + f"SELECT {COUNTERS_SQL}, 'prod' AS tag_env, 'data' AS tag_team FROM ev")
def metric_tags_query(spark, sf_dir):
    tagged = om.metric_tags(om.event_counters(event_rows(spark, sf_dir)), "env=prod,team=data")
    tags = [F.col("tags")[t].alias(f"tag_{t}") for t in ("env", "team")]
    return tagged.select("*", *tags).drop("tags")


@query(
    "heartbeats",
    V
    + """SELECT '__heartbeat.app' AS topic, (ms // 3600000 + 1) * 3600000 AS interval_end, arg_max(offsets, seq) AS offsets
      FROM vec GROUP BY ms // 3600000""",
)
def heartbeats_query(spark, sf_dir):
    rows = vector_rows(spark, sf_dir).withColumn("ts_ms", ts())
    return om.heartbeats(rows, 3_600_000, EVENTS_CONFIG.heartbeat_prefix, PREFIX)


@query(
    "current_state",
    E
    + """SELECT user_id, seq, op, event_type, value FROM
      (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS rn FROM ev) WHERE rn = 1 AND op <> 'd'""",
)
def current_state_query(spark, sf_dir):
    rows = event_rows(spark, sf_dir).select("seq", "op", "user_id", F.struct("event_type", "value").alias("after"))
    return ost.current_state(rows, "user_id").select("user_id", "seq", "op", "after.event_type", "after.value")


@query("column_include", "SELECT user_id AS key_user_id, event_type, value FROM events")
def column_include_query(spark, sf_dir):
    keyed = oe.event_key(fx.events_changelog(spark, sf_dir), ["user_id"])
    kept = oc.select_columns(keyed, f"{DB}\\.{TABLE}\\.event_type,.*\\.val.*", db=DB, table=TABLE)
    return kept.drop(*[c for c in META_COLUMNS if c in kept.columns]).withColumn("key", F.col("key.user_id")).withColumnRenamed(
        "key", "key_user_id"
    )


@query("column_exclude", E + "SELECT seq, user_id AS key_user_id, event_type, value FROM log")
def column_exclude_query(spark, sf_dir):
    keyed = oe.event_key(fx.events_changelog(spark, sf_dir), ["user_id"])
    kept = oc.select_columns(keyed, exclude=".*\\.(user_id|props|ts)", db=DB, table=TABLE)
    dropped = [c for c in META_COLUMNS if c in kept.columns and c != "seq"]
    return kept.drop(*dropped).withColumn("key", F.col("key.user_id")).withColumnRenamed("key", "key_user_id")


@query(
    "unchanged_updates",
    E + "SELECT seq, op, event_type FROM ev WHERE NOT (op = 'u' AND value < 100)",
)
def unchanged_updates_query(spark, sf_dir):
    # The log holds no old row; this stands in for one, equal to the new row where value is small.
    before = F.when(F.col("value") < 100, F.col("event_type"))
    rows = event_rows(spark, sf_dir).select("seq", "op", "event_type", before.alias("before"))
    return oe.drop_unchanged_updates(rows.withColumn("after", F.col("event_type"))).select("seq", "op", "event_type")


@query("unchanged_updates_without_before", E + "SELECT seq, user_id AS key_user_id, op FROM ev")
def unchanged_updates_without_before_query(spark, sf_dir):
    return oe.drop_unchanged_updates(events_of(spark, sf_dir)).select("seq", F.col("key.user_id").alias("key_user_id"), "op")


@query("drop_empty", E + "SELECT seq, op FROM ev WHERE op <> 'd'")
def drop_empty_query(spark, sf_dir):
    return oe.drop_empty(events_of(spark, sf_dir), enabled=True).select("seq", "op")


@query(
    "custom_hooks",
    E
    + """SELECT seq, 'all_events_' || op AS topic, CASE WHEN op <> 'd' THEN upper(event_type) END AS event_type, 'extra' AS tag
      FROM ev""",
)
def custom_hooks_query(spark, sf_dir):
    hooks = Hooks(
        converters={r".*\.event_type": F.upper},
        post_processors=[lambda df: df.withColumn("topic", F.concat_ws("_", "topic", "op"))],
        topic=lambda config: F.lit("all_events"),
        source=lambda s: s.withField("tag", F.lit("extra")),
    )
    return events_of(spark, sf_dir, hooks=hooks).select("seq", "topic", "after.event_type", "source.tag")


@query("processing_time", E + "SELECT seq, op, true AS within_a_day, true AS same_in_source FROM ev")
def processing_time_query(spark, sf_dir):
    """Events stamped by the clock: one moment for the whole run, in the event and in its source."""
    events = cdc_events(fx.events_changelog(spark, sf_dir), EVENTS_TABLE, EVENTS_CONFIG)
    now = F.unix_millis(F.current_timestamp())
    return events.select(
        "seq",
        "op",
        (F.abs(now - F.col("ts_ms")) < 86_400_000).alias("within_a_day"),
        (F.col("ts_ms") == F.col("source.ts_ms")).alias("same_in_source"),
    )
