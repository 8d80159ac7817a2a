"""Secret scans with an incremental blob ledger.

A text is a blob, named by its SHA-256. The ledger is a Parquet folder with one
row per blob and rule version that was ever scanned; a scan looks only at blobs
which the ledger lacks for its rule version, appends them, and joins the
ledger's findings back to every row (path) that holds the blob. A blob that
many rows share, or that comes back in a later version of the corpus, is read
by the rules once. The append is one Parquet write job, so a lost executor
repeats tasks and a failed job leaves no rows; a blob that two scans append at
the same time shows up twice with equal findings and is folded when read.

Spans are code points, end exclusive. Cases: NULL text is the empty text.
Repeated rows and ids get the findings of their own text. NULL ids are kept.
An empty table adds nothing and gives an empty result. Other columns are not
read. All patterns take time in proportion to the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymart.llm.common import pieces
from quaymart.session import scratch_path, stage

RULE_VERSION = 3     # goes up with every change of the rules, so that texts are scanned again
LEDGER = "blob string, rule_version int, findings array<struct<kind:string,start:int,end:int>>"
BASE_KINDS = ("assign", "access", "hex")
MASK = "[SECRET]"

_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
# kind -> (text that any match holds, pattern); the order is that of spans with the same start.
_OTHERS = {
    "access": ("AKIA", re.compile(r"AKIA[A-Z0-9]{16,}")),
    "hex": ("", re.compile(r"[0-9a-f]{24,}")),
    "pem": ("PRIVATE KEY", re.compile(r"-----BEGIN ([A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?)-----")),
    "jwt": ("eyJ", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    "github": ("gh", re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}")),
    "slack": ("xox", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}")),
    "google": ("AIza", re.compile(r"\bAIza[0-9A-Za-z_-]{35}")),
    "login": ("://", re.compile(r"://[^\s/:@]{1,256}:[^\s/@]{1,256}@")),
}
KINDS = ("assign", *_OTHERS)
_PEM_END = re.compile(r"-----END ([A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?)-----")
# What may follow a BEGIN line that has no END line: base64, line ends (also escaped), header lines.
_PEM_OPEN = re.compile(r"(?:(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID):[^\r\n\\]*+|\\++[nrt/]|[A-Za-z0-9+/=\s])*+")


def _pem(text: str) -> Iterator[tuple[int, int]]:
    """Private keys: to the END line of the same label if it comes before the next BEGIN line, else as far as they go on."""
    begins = list(_OTHERS["pem"][1].finditer(text))
    for m, after in zip(begins, [*(b.start() for b in begins[1:]), len(text)]):
        end = next((e.end() for e in _PEM_END.finditer(text, m.end(), after) if e[1] == m[1]), None)
        yield m.start(), end or _PEM_OPEN.match(text, m.end(), after).end()


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans of one text, by start, then by kind."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    for n, (sign, pattern) in enumerate(_OTHERS.values(), 1):
        if sign in text and KINDS[n] == "pem":
            out += [(start, n, end) for start, end in _pem(text)]
        elif sign in text:
            out += [(m.start(), n, m.end()) for m in pattern.finditer(text)]
    return [(KINDS[n], start, end) for start, n, end in sorted(out)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        for part in pieces(batch):
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in find(t or "")] for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("blob"), pa.array(found, kind)], ["blob", "findings"])


def blob_of(text: str = "text"):
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def new_ledger(spark: SparkSession) -> str:
    """An empty ledger in the shared folder."""
    path = scratch_path(spark, "ledger")
    spark.createDataFrame([], LEDGER).write.parquet(path)
    return path


def ledger_rows(spark: SparkSession, path: str, rule_version: int = RULE_VERSION) -> DataFrame:
    """``blob, findings``, once per blob."""
    rows = spark.read.schema(LEDGER).parquet(path).filter(F.col("rule_version") == rule_version)
    return rows.groupBy("blob").agg(F.first("findings").alias("findings"))


def scan(docs: DataFrame, ledger: str | None = None, rule_version: int = RULE_VERSION) -> DataFrame:
    """``doc_id, blob, findings`` for every row of ``docs``; unseen blobs are added to the ledger."""
    spark = docs.sparkSession
    ledger = ledger or new_ledger(spark)
    paths = stage(docs.select("doc_id", blob_of().alias("blob")))
    seen = spark.read.schema(LEDGER).parquet(ledger).filter(F.col("rule_version") == rule_version).select("blob")
    # One row stands for all that hold the same blob; only its text travels.
    unseen = paths.groupBy("blob").agg(F.min("doc_id").alias("at")).join(seen, "blob", "left_anti")
    texts = docs.select("doc_id", "text", blob_of().alias("held"))
    texts = (
        texts.join(unseen.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("at")) & (F.col("held") == F.col("blob")))
        .select("blob", F.coalesce("text", F.lit("")).alias("text"))
    )
    found = texts.mapInArrow(_scan, "blob string, findings array<struct<kind:string,start:int,end:int>>")
    # Rows that repeat an id and its text stand for the same blob.
    found = found.groupBy("blob").agg(F.first("findings").alias("findings"))
    found.select("blob", F.lit(rule_version).alias("rule_version"), "findings").write.mode("append").parquet(ledger)
    # A staged copy of both sides: two plain shuffles, which may split a blob that a third of the rows hold.
    return paths.join(stage(ledger_rows(spark, ledger, rule_version)), "blob").select("doc_id", "blob", "findings")


def joined(findings: str, kinds: tuple[str, ...] | None = None):
    """kind:start:end of the findings (of some kinds), comma-joined."""
    col = F.col(findings)
    if kinds is not None:
        col = F.filter(col, lambda f: f["kind"].isin(*kinds))
    return F.array_join(F.transform(col, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def count_kind(findings: str, kind: str):
    return F.size(F.filter(F.col(findings), lambda f: f["kind"] == kind)).cast("bigint")


def mask(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with every span (overlaps joined) replaced by a mark."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join(out) + text[at:]


def _mask_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            texts = [t if not f else mask(t, [(x["start"], x["end"]) for x in f])
                     for t, f in zip(part.column("text").to_pylist(), part.column("_findings").to_pylist())]
            cols = [pa.array(texts, pa.string()) if n == "text" else part.column(n) for n in part.schema.names if n != "_findings"]
            yield pa.RecordBatch.from_arrays(cols, [n for n in part.schema.names if n != "_findings"])


def redact(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """``docs`` with all found spans masked; every row stays. ``n_chars``, if there, follows the text."""
    found = scan(docs, ledger).filter(F.size("findings") > 0).groupBy("doc_id", "blob").agg(F.first("findings").alias("_findings"))
    found = stage(found.withColumnRenamed("doc_id", "_id").withColumnRenamed("blob", "_blob"))
    marked = docs.join(found.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_blob") == blob_of()), "left")
    out = marked.select(*docs.columns, "_findings").mapInArrow(_mask_rows, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
