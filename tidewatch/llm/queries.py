"""Registered queries of the training-data operators and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from . import bpe, collocations, decontam, html_extract, langid, license_scan, line_dedup, merkle, packing, quality, secret_scan, simhash, winnow
from .common import id_fold, prepare, table
from .oracle import SQL

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = id_fold(F.col("doc_id"), 5) == 0
    model = quality.fit(documents, labels.where(~held_out))
    found = quality.score(documents, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = id_fold(F.col("doc_id"), 4) == 2
    profiles = langid.fit(documents.where(~held_out))
    return langid.predict(documents, profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scans with one stored ledger, which together cover the table: every document is one version of the path that its id
    names, and the second half of the versions is scanned only where the first has not seen the blob."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    late = id_fold(F.col("doc_id"), 2) == 1
    ledger = stored(secret_scan.scan(documents.where(~late)))
    entries = ledger.unionByName(stored(secret_scan.scan(documents.where(late), ledger)))
    return secret_scan.digest(secret_scan.findings_by_path(documents, entries, ["doc_id"]))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, removed lines (their numbers from 0) and the SHA-256 of what is left."""
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"),
        F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), near=2)


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = max(64, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    return winnow.edited_likeness(table(spark, sf_dir, "documents"), buckets)


#: Path of a document in a made-up tree: source / ten thousands / thousands / name. Ids that 100 divides
#: are licence files of the upper directory, others that 10 divides of the lower one.
DOC_PATH = """concat(coalesce(source, 'none'), '/', coalesce(doc_id, 0) div 10000, '/',
    case when doc_id % 100 = 0 then '' else concat((coalesce(doc_id, 0) div 1000) % 10, '/') end,
    case when doc_id % 10 = 0 then 'LICENSE-' else 'doc-' end, coalesce(doc_id, -1), '.txt')"""


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return license_scan.scan(documents.select(F.expr(DOC_PATH).alias("path"), "text"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents; half of them are checked with a copy that has lost its line ends."""
    tampered = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(2)) == 0
    claimed = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.manifest(table(spark, sf_dir, "documents"), claimed)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and what they decode to."""
    import public_tokenizers
    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    found = bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("packed", 256).alias("ids_sha256"),
                        F.sha2(bpe.decode(F.col("ids"), path), 256).alias("decoded_sha256"))


def _prepared(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    return run


REGISTRY = {fn.__name__: _prepared(fn) for fn in (
    op1_quality, op2_simhash, op3_packing, op4_langid, op5_secrets, op6_line_dedup, op7_html, op8_decontamination,
    op9_winnowing, op10_licenses, op11_merkle,
    op12_collocations, op13_bpe)}

__all__ = ["REGISTRY", "SQL"]
