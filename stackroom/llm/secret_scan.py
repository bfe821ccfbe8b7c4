"""Secret scans with an incremental ledger of contents.

Every version of every file is a row (path id, text). Its content address is the SHA-256 of the text. The ledger is a
Parquet table of the contents already scanned, one row for each (content, version of the rules) with what was found.
A scan reads only contents that the ledger has not seen under the present version, appends them, and joins findings
back to every path that has the content.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stackroom.functions.columns import field
from stackroom.operators.joins import join_per_key

from .common import free_shuffles, row_by_row, slices

#: The base kinds, in the order in which spans with one start are listed.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Further kinds, after the base kinds in that order.
MORE = {
    "code_host": re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"),
    "chat": re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    "private_key": re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
}
KINDS = (*BASE_KINDS, *MORE)
#: Change it with any pattern: contents are then scanned again.
RULES_VERSION = 1

KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"key")
HEX_DIGITS = bytes(104 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
LONG_HEX = b"h" * 24


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int


def find_spans(text: str | None) -> list[Span]:
    """All spans of all kinds, by start, then kind as listed; offsets are code points, the end is exclusive.

    The searches for plain bytes before the patterns only leave out patterns that cannot match.
    """
    text = text or ""
    raw = text.encode("utf-8", "replace")
    lower = raw.lower()
    found = []
    if any(word in lower for word in KEYWORDS):
        found += [Span("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if b"AKIA" in raw:
        found += [Span("access", *m.span()) for m in ACCESS.finditer(text)]
    if LONG_HEX in raw.translate(HEX_DIGITS):
        found += [Span("hex", *m.span()) for m in HEX.finditer(text)]
    for kind, mark in (("code_host", b"gh"), ("chat", b"xox"), ("private_key", b"-----BEGIN ")):
        if mark in raw:
            found += [Span(kind, *m.span()) for m in MORE[kind].finditer(text)]
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def redact(text: str | None, spans: str | None) -> str | None:
    """``text`` with every listed span, overlapping ones together, replaced by ``[secret]``."""
    if text is None or not spans:
        return text
    out, at, reach = [], 0, -1
    for start, end in sorted(tuple(map(int, s.split(":")[1:])) for s in spans.split(",")):
        if start >= reach:
            out += [text[at:start], "[secret]"]
        reach = max(reach, end)
        at = reach
    return "".join([*out, text[at:]])


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


FINDING = "blob string, rules_version int, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
LEDGER = f"{FINDING}, scan int"


def scan_blobs(blobs: DataFrame, version: int) -> DataFrame:
    """A finding row for each row (blob, text)."""

    def scan(blob, text):
        spans = find_spans(text)
        base = [s for s in spans if s.kind in BASE_KINDS]
        counts = [sum(s.kind == k for s in base) for k in BASE_KINDS]
        return blob, version, *counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)

    schema = pa.schema([("blob", pa.string()), ("rules_version", pa.int32()), *((f"n_{k}", pa.int64()) for k in BASE_KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])
    return blobs.select("blob", "text").mapInArrow(row_by_row(scan, schema), FINDING)


def read_ledger(docs: DataFrame, ledger: str, version: int) -> DataFrame:
    spark = docs.sparkSession
    try:
        table = spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], LEDGER)
    return table.where(F.col("rules_version") == version)


def update_ledger(docs: DataFrame, ledger: str, version: int = RULES_VERSION) -> None:
    """Scan the contents of ``docs`` that ``ledger`` has not seen under ``version`` and append them, with the number of this scan.

    Copies meet in one aggregation that keeps one text for each content already on the map side, so a content that a
    third of all rows has is one row per map task after it. Known contents are left out by an anti join before that.
    """
    texts = docs.select(blob_id(F.col("text")).alias("blob"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ledger_rows = read_ledger(docs, ledger, version)
    scans = ledger_rows.agg(F.coalesce(F.max("scan"), F.lit(0))).first()[0]
    unseen = texts.join(ledger_rows.select("blob").distinct(), "blob", "left_anti") if scans else texts
    found = scan_blobs(unseen.groupBy("blob").agg(F.first("text").alias("text")), version)
    found.withColumn("scan", F.lit(scans + 1)).write.mode("append").parquet(ledger)
    free_shuffles(docs.sparkSession)


def scan_versions(docs: DataFrame, ledger: str, version: int = RULES_VERSION) -> DataFrame:
    """doc_id, blob and findings of every row of ``docs``, through the ledger.

    Null text is the empty content; repeated rows and null ids each keep a row; equal contents share one scan.
    """
    update_ledger(docs, ledger, version)
    # An append that ran twice may leave a content twice; all its rows say the same.
    seen = read_ledger(docs, ledger, version).dropDuplicates(["blob"])
    paths = docs.select(F.col("doc_id").cast("long").alias("doc_id"), blob_id(F.col("text")).alias("blob"))
    return join_per_key(paths, seen, ["blob"], "inner")


def redact_documents(docs: DataFrame, ledger: str, version: int = RULES_VERSION) -> DataFrame:
    """All rows of ``docs`` with every finding in ``text`` replaced, and ``n_chars``, if there is one, as the text then has."""
    update_ledger(docs, ledger, version)
    found = read_ledger(docs, ledger, version).where("spans != ''").dropDuplicates(["blob"]).select("blob", "spans")
    rows = docs.select(F.struct(*[field(c) for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"), blob_id(F.col("text")).alias("blob"))
    joined = join_per_key(rows, found, ["blob"], "left").select("row", "text", "spans")

    def run(batches):
        for part in slices(batches):
            texts = [redact(*pair) for pair in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
            yield pa.record_batch([part.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    done = joined.mapInArrow(run, StructType([joined.schema["row"], StructField("text", StringType())]))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return done.select(*(changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))
