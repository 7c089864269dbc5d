"""Operator 6, secret scans over an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its text). The ledger, a Parquet table
in a shared folder, holds one row per (blob, rule version) scanned before, with its findings; only
blobs without such a row are scanned, each once however many paths and versions hold it, and the
findings are joined back to all paths. A second run over a grown history scans the new blobs only;
a new rule version scans everything again and leaves the old findings in place.

The blob that stands for its copies is picked by a grouped minimum over (hash, row key) pairs, which
are pre-aggregated before their shuffle, so a blob that a third of all rows hold costs one row per
task. Texts are shuffled once, and only where a ledger entry is missing.

Defined cases: a null text is the empty blob (no findings); null keys are keys like any other (null-safe
joins); repeated rows come out as often as they went in; an empty table gives an empty result and adds
nothing to the ledger; extra columns, also called like the working columns, are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import scratch_path
from .base import map_arrow, pieces, sha256_hex, table

RULES_VERSION = "2"
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of hex digits matches as a whole, so asking for 24 finds the same spans as filtering by length.
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Rules beyond the base: private key blocks, JSON web tokens, prefixed service tokens.
_MORE = (("pem", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]*-----END [A-Z ]*PRIVATE KEY-----")),
         ("jwt", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
         ("prefixed", re.compile(r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})")))
KINDS = ("assign", "access", "hex", *(k for k, _ in _MORE))
BASE = KINDS[:3]
FINDINGS = "array<struct<kind:string,start:int,end:int>>"


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every finding, by start, then by the order of KINDS; end exclusive."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    for kind, rule in _MORE:
        found += [(kind, *m.span()) for m in rule.finditer(text)]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def _scan(batches):
    for b in pieces(batches):
        found = [[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t or "")] for t in b.column(1).to_pylist()]
        kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kinds)], names=["blob", "findings"])


def scan_history(history: DataFrame, ledger: str, text: str = "text", key: str = "doc_id", rules: str = RULES_VERSION) -> DataFrame:
    """Bring the ledger at path ``ledger`` up to date with ``history`` and return its (blob, findings)
    for this rule version. ``key`` names a column that tells most rows apart (path, version or id): it
    only picks the row that is scanned for a blob, so repeated keys are allowed."""
    spark = history.sparkSession
    rows = history.select(F.unhex(sha256_hex(F.col(text))).alias("blob"), F.col(key).alias("k"), F.col(text).alias("t"))
    jpath = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    old = None
    if jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        old = spark.read.schema(f"blob binary, rules string, findings {FINDINGS}").parquet(ledger).filter(F.col("rules") == rules)
    firsts = rows.groupBy("blob").agg(F.min(F.struct("k")).alias("f")).select(F.col("blob").alias("b1"), F.col("f.k").alias("k1"))
    if old is not None:
        firsts = firsts.join(old.select(F.col("blob").alias("b1")).distinct(), "b1", "left_anti")
    unseen = rows.join(firsts, F.expr("k <=> k1 and blob = b1"), "left_semi").select("blob", "t")
    # rows repeated with the same key are scanned twice and stored once
    scanned = map_arrow(unseen, _scan, f"blob binary, findings {FINDINGS}").groupBy("blob").agg(F.first("findings").alias("findings"))
    scanned.select("blob", F.lit(rules).alias("rules"), "findings").write.mode("append").parquet(ledger)
    return spark.read.schema(f"blob binary, rules string, findings {FINDINGS}").parquet(ledger).filter(F.col("rules") == rules).select("blob", "findings")


def with_findings(history: DataFrame, ledger_rows: DataFrame, columns: list, text: str = "text") -> DataFrame:
    """``columns`` of every row of ``history`` with the findings of its blob (column ``findings``).
    Blobs without findings are left out of the join, so most rows meet nothing."""
    rows = history.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("d"), F.unhex(sha256_hex(F.col(text))).alias("blob"))
    hits = ledger_rows.filter(F.size("findings") > 0)
    return rows.join(hits, "blob", "left").select("d.*", F.coalesce("findings", F.expr(f"cast(array() as {FINDINGS})")).alias("findings"))


def span_text(findings, kinds=KINDS):
    """kind:start:end of the findings of these kinds, comma-joined in their order."""
    f = F.filter(findings, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(f, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, BASE), F.sha2(span_text(F.col("findings"), BASE).cast("binary"), 256).alias("base_sha256"),
                        span_text(F.col("findings")).alias("spans"))


def ledger_path(spark, name: str | None) -> str:
    """The ledger called ``name``: a folder beside those of the streams that later runs find again.
    Without a name, a new scratch folder: an empty ledger."""
    from ..streaming.streams import stream_base

    return stream_base(spark, f"ledger-{name}") if name else scratch_path(spark, "ledger")


def q_blob_ledger(spark, sf_dir, ledger: str | None = None):
    """Digest of the findings of ``documents``; with the name of a ledger only blobs new to it are scanned."""
    docs = table(spark, sf_dir, "documents")
    return digest(with_findings(docs, scan_history(docs, ledger_path(spark, ledger)), ["doc_id"]))


MARK = "[secret]"


def redact(text: str, findings: list) -> str:
    """The text with every found span, overlapping ones merged, replaced by one mark."""
    out, at = [], 0
    spans: list[list[int]] = []
    for f in findings:
        if spans and f["start"] < spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], f["end"])
        else:
            spans.append([f["start"], f["end"]])
    for s, e in spans:
        out += [text[at:s], MARK]
        at = e
    return "".join([*out, text[at:]])


def stage_blob_ledger(spark, docs, sf_dir, ledger: str | None = None):
    """Pipeline stage: no document goes; every secret found in a text is replaced by ``[secret]`` and
    n_chars counts the new text. With the name of a ledger only blobs new to it are scanned."""
    found = with_findings(docs, scan_history(docs, ledger_path(spark, ledger)), [*docs.columns])
    at, n_at = docs.columns.index("text"), docs.columns.index("n_chars")

    def run(batches):
        for b in pieces(batches):
            cols = list(b.columns)
            texts, found_ = cols[at].to_pylist(), cols.pop().to_pylist()
            if any(found_):
                n = cols[n_at].to_pylist()
                for i, f in enumerate(found_):
                    if f:
                        texts[i] = redact(texts[i], f)
                        n[i] = len(texts[i])
                cols[at], cols[n_at] = pa.array(texts, cols[at].type), pa.array(n, cols[n_at].type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1])

    return map_arrow(found, run, docs.schema)


def brute_force(text: str | None) -> dict:
    """The contract's base rules, spelled out, for tests."""
    text, spans = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A | re.I):
        if len(m[2]) >= 6:
            spans.append((m.start(), 0, m.end()))
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    joined = ",".join(f"{BASE[k]}:{s}:{e}" for s, k, e in sorted(spans))
    return {f"n_{b}": sum(k == i for _, k, _ in spans) for i, b in enumerate(BASE)} | {"base_sha256": hashlib.sha256(joined.encode()).hexdigest()}
