"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content. The ledger holds one entry per
(blob, rule version) that has been scanned, with its findings, also when there are none. A scan takes
the blobs that have no entry yet, one copy of each, and joins the findings back to all paths and
versions that ever held the blob.

Positions are code points. Spark's regular expression functions return texts, not places, so a rule's
matches are placed by adding up the lengths of the matches and of the pieces between them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has at least ``min_chars`` code points."""

    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 1


#: a run that is shorter than its minimum can hold no longer one, so the last two rules ask for the length at once
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}+", 0, 32),
)
RULE_VERSION = "1"

LEDGER = "blob string, rule_version string, findings array<struct<start:long,rule:int,kind:string,end:long>>"


def blob_of(text: Column) -> Column:
    """Content address; a null text has the address of the empty one."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def _places(text: Column, number: int, rule: Rule) -> Column:
    """array of (rule, i, before, match, value): lengths of each match, its group, and the piece before it."""
    pattern = F.lit(rule.pattern)
    lengths = lambda texts: F.transform(texts, lambda x: F.char_length(x).cast("long"))
    before = lengths(F.split(text, rule.pattern, -1))
    match = lengths(F.regexp_extract_all(text, pattern, F.lit(0)))
    value = lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))) if rule.group else match
    zipped = F.arrays_zip(before.alias("before"), match.alias("match"), value.alias("value"))
    found = F.transform(zipped, lambda x, i: F.struct(
        F.lit(number).alias("rule"), i.alias("i"), x["before"].alias("before"), x["match"].alias("match"), x["value"].alias("value")))
    none = F.expr("cast(array() as array<struct<rule:int,i:int,before:long,match:long,value:long>>)")
    return F.when(F.regexp_like(text, pattern), found).otherwise(none)


def unseen_blobs(versions: DataFrame, ledger: DataFrame | None, rule_version: str) -> DataFrame:
    """(blob, text): one copy of every blob that the ledger does not have under this rule version."""
    blobs = versions.select(blob_of(F.col("text")).alias("blob"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # copies meet in the partial aggregation before the shuffle; the ledger is joined on the same key
    blobs = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is None:
        return blobs
    return blobs.join(ledger.where(F.col("rule_version") == rule_version).select("blob"), "blob", "left_anti")


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION) -> DataFrame:
    """Ledger entries of ``blobs`` (blob, text); findings are ordered by start, then by the order of rules."""
    places = F.concat(*[_places(F.col("text"), k, rule) for k, rule in enumerate(rules)])
    rows = blobs.select("blob", F.explode_outer(places).alias("p")).select("blob", "p.*")
    so_far = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("before") + F.coalesce("match", F.lit(0))).over(so_far)
    needed = F.element_at(F.array(*[F.lit(r.min_chars) for r in rules]), F.col("rule") + 1)
    kind = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("rule") + 1)
    found = rows.withColumn("end", end).withColumn("finding", F.when(
        F.col("match").isNotNull() & (F.col("value") >= needed),
        F.struct((F.col("end") - F.col("match")).alias("start"), F.col("rule"), kind.alias("kind"), F.col("end"))))
    return found.groupBy("blob").agg(F.sort_array(F.collect_list("finding")).alias("findings")).select(
        "blob", F.lit(rule_version).alias("rule_version"), "findings")


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
         rule_version: str = RULE_VERSION) -> DataFrame:
    """New ledger entries for ``versions`` (any table with ``text``); append them to the ledger.

    Null texts are the empty blob. Repeated texts are scanned once. An empty table gives no entries.
    """
    return scan_blobs(unseen_blobs(versions, ledger, rule_version), rules, rule_version)


def findings_by_path(versions: DataFrame, entries: DataFrame, path: list[str]) -> DataFrame:
    """``path`` columns and findings of every row of ``versions``, rows without an entry with null findings."""
    history = versions.select(*path, blob_of(F.col("text")).alias("blob"))
    return history.join(entries.select("blob", "findings"), "blob", "left").drop("blob")


def _count(findings: Column, rule: int) -> Column:
    return F.size(F.filter(findings, lambda f: f["rule"] == rule)).cast("long")


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts per rule, the spans as text (kind:start:end, comma-joined) and their SHA-256."""
    findings = F.coalesce("findings", F.expr("cast(array() as array<struct<start:long,rule:int,kind:string,end:long>>)"))
    spans = F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
    counts = [_count(findings, k).alias(f"n_{rule.kind}") for k, rule in enumerate(rules)]
    keep = [c for c in found.columns if c != "findings"]
    return found.select(*keep, *counts, F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))
