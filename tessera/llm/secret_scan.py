"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content.  The ledger is a
Parquet table with one row per (blob, rule version): its findings, possibly none.  A run
scans the blobs that the ledger lacks under the current rules, appends them, and joins the
findings back to all paths.  Positions are code points, ends exclusive.

Defined cases: null content is the empty blob; equal contents are scanned once however many
paths hold them; every input row gives one row (equal rows too); null paths are kept; an
empty table gives no rows; other columns are ignored.  One run writes to a ledger at a time.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_dir
from tessera.sources.tables import path_exists, table

# Fixed values: (kind, pattern, group whose length counts, least length, letters in either case, literals one of which starts a match)
RULES = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True,
     ("password", "passwd", "secret", "token", "api_key", "apikey")),
    ("access", r"AKIA[A-Z0-9]+", 0, 18, False, ("AKIA",)),
    ("hex", r"[0-9a-f]{16,}", 0, 16, False, ()),
    ("pem", r"-----BEGIN\x20(?:[A-Z]+\x20)*PRIVATE\x20KEY-----", 0, 1, False, ("-----BEGIN ",)),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40, False, ("eyJ",)),
    ("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40, False, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 24, False, ("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-")),
]
BASE = ("assign", "access", "hex")
STEP = 256  # rows whose contents are Python strings at one time
SPANS = "array<struct<kind:string,start:long,end:long>>"


def rule_version(rules=RULES) -> str:
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def _compiled(rules):
    return [(k, kind, re.compile(p, re.ASCII | (re.IGNORECASE if either else 0)), group, least, either, literals)
            for k, (kind, p, group, least, either, literals) in enumerate(rules)]


def find_spans(text: str, compiled) -> list[tuple[int, int, int, str]]:
    """(start, rule order, end, kind) of all findings, sorted.

    Matches are leftmost and do not overlap within a kind; one that is too short is dropped
    after it has taken its place.  A rule with literals is tried only where one stands.
    """
    out = []
    low = text.lower()
    for k, kind, pattern, group, least, either, literals in compiled:
        if not literals or either and len(low) != len(text):
            found = pattern.finditer(text)
        else:
            found = _at_literals(low if either else text, text, pattern, literals)
        out += [(m.start(), k, m.end(), kind) for m in found if m.end(group) - m.start(group) >= least]
    return sorted(out)


def _at_literals(searched: str, text: str, pattern, literals):
    starts = set()
    for x in literals:
        at = searched.find(x)
        while at >= 0:
            starts.add(at)
            at = searched.find(x, at + 1)
    end = 0
    for at in sorted(starts):
        if at >= end and (m := pattern.match(text, at)):
            end = m.end()
            yield m


def _scan(blobs: DataFrame, rules) -> DataFrame:
    """(sha, rules, spans) of (sha, content) rows."""
    version, kind = rule_version(rules), pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def read(batches):
        compiled = _compiled(rules)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                got = [[{"kind": x[3], "start": x[0], "end": x[2]} for x in find_spans(t, compiled)] for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([version] * len(got), pa.string()), pa.array(got, pa.list_(kind))],
                                                 names=["sha", "rules", "spans"])

    return blobs.select("sha", "content").mapInArrow(read, f"sha string, rules string, spans {SPANS}")


def update_ledger(versions: DataFrame, ledger: str, path_col: str = "path", content_col: str = "content", rules=RULES) -> DataFrame:
    """Scan what ``ledger`` lacks, append it, and return the ledger rows under these rules.

    Each unseen blob is read from one place that holds it, so copies are not shuffled to one task.
    """
    spark = versions.sparkSession
    content = F.coalesce(F.col(content_col), F.lit(""))
    held = versions.select(F.col(path_col).alias("path"), F.sha2(content, 256).alias("sha"))
    unseen = held.groupBy("sha").agg(F.min("path").alias("path"))
    if path_exists(spark, ledger):
        known = spark.read.schema(f"sha string, rules string, spans {SPANS}").parquet(ledger).where(F.col("rules") == rule_version(rules))
        unseen = unseen.join(known.select("sha"), "sha", "left_anti")
    source = versions.select(F.col(path_col).alias("at"), F.sha2(content, 256).alias("sha"), content.alias("content"))
    pick = unseen.select(F.col("sha").alias("want"), F.col("path").alias("want_at")).hint("shuffle_hash")
    chosen = source.join(pick, (source["sha"] == pick["want"]) & source["at"].eqNullSafe(pick["want_at"]), "left_semi")
    _scan(chosen, rules).dropDuplicates(["sha"]).write.mode("append").parquet(ledger)
    return spark.read.schema(f"sha string, rules string, spans {SPANS}").parquet(ledger).where(F.col("rules") == rule_version(rules))


def findings(versions: DataFrame, ledger: str, path_col: str = "path", content_col: str = "content", rules=RULES) -> DataFrame:
    """Per input row: path, sha, spans (by start, then rule order)."""
    done = update_ledger(versions, ledger, path_col, content_col, rules).select("sha", "spans")
    held = versions.select(F.col(path_col).alias("path"), F.sha2(F.coalesce(F.col(content_col), F.lit("")), 256).alias("sha"))
    return held.join(done, "sha").select("path", "sha", "spans")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = findings(table(spark, sf_dir, "documents"), scratch_dir(spark, "secret-ledger"), "doc_id", "text")
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    said = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    number = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind))
    return found.select(
        F.col("path").alias("doc_id"), *[number(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"), F.col("sha").alias("blob_sha256"))
