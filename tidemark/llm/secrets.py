"""Secret scans: an incremental blob ledger.

Every version of a document is a blob, named by the hash of its bytes. Only pairs
of blob and rule version that the ledger does not hold are scanned, each blob once
however many paths carry it; findings are then joined back to all paths.
DataFrame functions only. The texts are shuffled once, on keys that are unique
(blob and its first path), so no path or blob is hot there; everything after is
narrow.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import text_or_empty


def either_case(words: str) -> str:
    """A pattern whose ASCII letters match in both cases, the same in every regex engine."""
    return "".join(f"[{c.upper()}{c}]" if c.isascii() and c.islower() else c for c in words)


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


# The base kinds, in their order.
ASSIGN = either_case("(password|passwd|secret|token|api_?key)") + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    Rule("assign", 1, ASSIGN, 2, 6),
    Rule("access", 1, "AKIA[A-Z0-9]{16,}"),
    # Short runs of these digits are in every word; a run this long is the same match as a long enough run.
    Rule("hex", 1, "[0-9a-f]{24,}"),
)
MORE = (
    Rule("pem", 1, "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + MORE

PAIRS = "blob binary, kind string, version int"
FINDINGS = "blob binary, kind string, version int, start long, end long"


def _pair_rows(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    return blobs.withColumn("rule", F.explode(wanted)).select("*", "rule.kind", "rule.version").drop("rule")


def _steps(text: Column, rule: Rule) -> Column:
    """Lengths of what lies before each match, of the match, and of its judged group; null without a match."""
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    gaps = F.split(text, rule.pattern, -1)
    judged = (lambda h: F.regexp_extract(h, rule.pattern, rule.group)) if rule.group else (lambda h: h)

    def lengths(hit: Column, i: Column) -> Column:
        return F.struct(
            i.alias("i"),
            F.char_length(F.get(gaps, i)).cast("long").alias("gap"),
            F.char_length(hit).cast("long").alias("hit"),
            (F.char_length(judged(hit)) >= rule.least).alias("good"),
        )

    return F.when(F.regexp_like(text, F.lit(rule.pattern)), F.transform(hits, lengths))


def scan(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of ``blob, text, kinds``: leftmost matches that do not overlap, by kind, in code points, end exclusive.

    Positions are running sums over the matches in order, so a text with very many
    matches costs in proportion to them.
    """
    steps = [
        F.struct(
            F.lit(r.kind).alias("kind"),
            F.lit(r.version).alias("version"),
            F.when(F.array_contains("kinds", r.kind), _steps(F.col("text"), r)).alias("steps"),
        )
        for r in rules
    ]
    rows = texts.select("blob", F.explode(F.array(*steps)).alias("r")).where("r.steps is not null")
    rows = rows.select("blob", "r.kind", "r.version", F.inline("r.steps"))
    # Rows that repeat both path and text are scanned together; their matches count once.
    rows = rows.distinct()
    before = Window.partitionBy("blob", "kind", "version").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("hit")).over(before))
    return placed.where("good").select("blob", "kind", "version", (F.col("end") - F.col("hit")).alias("start"), "end")


@dataclass(frozen=True)
class ScanResult:
    """What a run adds to the ledger: pairs scanned, and findings in them; and the versions with their blob."""

    pairs: DataFrame
    findings: DataFrame
    versions: DataFrame


def scan_versions(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    path_col: str = "doc_id",
    text_col: str = "text",
) -> ScanResult:
    """Scans what ``ledger`` (columns ``blob, kind, version``) has not seen.

    Null texts count as empty, and an empty blob is scanned like any other. A null
    path is a path. Rows that repeat path and text are one version. The caller
    appends ``pairs`` and ``findings`` to its tables; a new rule version makes every
    blob unseen for that rule alone.
    """
    text = text_or_empty(text_col)
    rows = versions.select(F.col(path_col).alias("path"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("blob"))
    narrow = rows.select("path", "blob")
    first = narrow.groupBy("blob").agg(F.min("path").alias("path"))
    pairs = _pair_rows(first, rules)
    if ledger is not None:
        pairs = pairs.join(ledger.select("blob", "kind", "version"), ["blob", "kind", "version"], "left_anti")
    todo = pairs.groupBy("blob", "path").agg(F.collect_set("kind").alias("kinds"))
    todo = todo.withColumnsRenamed({"blob": "todo_blob", "path": "todo_path"})
    same = (F.col("blob") == F.col("todo_blob")) & F.col("path").eqNullSafe(F.col("todo_path"))
    texts = rows.join(todo, same).select("blob", "text", "kinds")
    return ScanResult(pairs.select("blob", "kind", "version"), scan(texts, rules), narrow)


def join_back(versions: DataFrame, findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``path, blob, spans`` for every version: its blob's findings as ``start, rank, kind, end``, in that order.

    ``rank`` is the kind's place in ``rules``; findings of rule versions not in
    ``rules`` are left out. A blob's findings are bounded by its text. A blob
    that a third of all paths share meets its one row by a join that adaptive
    execution can split.
    """
    current = [F.when((F.col("kind") == r.kind) & (F.col("version") == r.version), i) for i, r in enumerate(rules)]
    ranked = findings.withColumn("rank", F.coalesce(*current)).where("rank is not null")
    spans = ranked.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("spans"))
    empty = F.from_json(F.lit("[]"), "array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return versions.join(spans, "blob", "left").select("path", "blob", F.coalesce("spans", empty).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")
