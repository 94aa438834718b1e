from __future__ import annotations

import pytest

from tidemark.config import CdcConfig, ConfigError, bad_offsets, parse_snapshot_mode
from tidemark.session import fresh_path, scale_conf, shared_dir

NEEDED = {"topic_prefix": "p", "db": "db", "table": "t"}


def test_defaults():
    c = CdcConfig(**NEEDED)
    assert (c.decimal_mode, c.binary_mode, c.time_mode) == ("precise", "bytes", "adaptive")
    assert (c.geography_mode, c.vector_mode, c.snapshot_mode) == ("geometry", "string", "initial")
    assert c.tombstones and not c.populate_internal_id
    assert (c.skipped_operations, c.failure_mode, c.heartbeat_interval_ms) == ("t", "fail", 0)
    assert c.offset_list is None and c.topic_delimiter == "."


@pytest.mark.parametrize("missing", ["topic_prefix", "db", "table"])
def test_required(missing):
    with pytest.raises(ConfigError, match=f"{missing} is required"):
        CdcConfig(**{k: v for k, v in NEEDED.items() if k != missing})


@pytest.mark.parametrize(
    "option, value",
    [
        ("decimal_mode", "exact"),
        ("binary_mode", "utf8"),
        ("time_mode", "advanced"),
        ("geography_mode", "precise"),
        ("vector_mode", "list"),
        ("failure_mode", "skip"),
        ("topic_strategy", "other"),
        ("skipped_operations", "x"),
        ("partitions", 0),
        ("offsets", "0123456789abcdefABCDEFGE"),
        ("topic_prefix", "a b"),
    ],
)
def test_invalid(option, value):
    with pytest.raises(ConfigError):
        CdcConfig(**{**NEEDED, option: value})


def test_offsets_option():
    assert bad_offsets("0123456789abcdefABCDEF,NULL,NULL,0123") == []
    assert bad_offsets("") == [] and bad_offsets(None) == []
    assert bad_offsets("NULL1,0x1") == ["NULL1", "0x1"]
    assert CdcConfig(**NEEDED, offsets="0A,null,NULL,01").offset_list == ["0A", None, None, "01"]


def test_snapshot_mode_text():
    assert parse_snapshot_mode(" When_Needed ") == "when_needed"
    assert parse_snapshot_mode("bogus") == "initial" == parse_snapshot_mode(None)


def test_from_options():
    c = CdcConfig.from_options(
        {
            "topic.prefix": "p",
            "database.dbname": "db",
            "database.table": "t",
            "tombstones.on.delete": "false",
            "heartbeat.interval.ms": "500",
            "column.mask.hash.SHA-256.with.salt.pepper": "db.t.a",
            "column.mask.with.10.chars": "db.t.b",
            "column.truncate.to.5.chars": "db.t.c",
        }
    )
    assert not c.tombstones and c.heartbeat_interval_ms == 500
    assert c.mask_hash == {("SHA-256", "pepper"): "db.t.a"}
    assert c.mask_chars == {10: "db.t.b"} and c.truncate == {5: "db.t.c"}
    with pytest.raises(ConfigError, match="unknown option"):
        CdcConfig.from_options({"topic.prefx": "p"})


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def test_shuffle_settings_follow_the_input():
    assert int(scale_conf(100 * 2**40)["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_conf(0, cores=8)["spark.sql.shuffle.partitions"]) == 16
