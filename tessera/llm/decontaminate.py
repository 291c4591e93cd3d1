"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share seeds (runs of ``MIN_TILE`` words) are joined;
each such pair is tiled: the longest common run of words that is free on both sides is
marked, again and again, down to ``MIN_TILE`` words.  Runs are found by Karp-Rabin hashes
and confirmed word by word.  A pair whose tiles cover at least ``MIN_COVERAGE`` of the item
is a leak, in whatever order the passages stand.

Work over all documents is one pass: every run of words is looked up in a bit filter of the
benchmark's seeds, whose size is fixed (``FILTER_BITS``).  A document goes on if it has at
least as many hits as the least coverage needs; the hits then meet the exact seeds in a join.

Defined cases: null and empty texts and items without words match nothing; an item of fewer
than ``MIN_TILE`` words is one seed; null ids are kept as they are; equal rows give equal
pairs; equal items each give their pair; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.common import stored
from tessera.sources.tables import table

MIN_TILE = 5
MIN_COVERAGE = 0.8
FILTER_BITS = 1 << 25

_I64 = pa.int64()


def _blob(h: np.ndarray) -> bytes:
    return h.astype("<u8").tobytes()


def _items(benchmark: DataFrame, tile: int) -> DataFrame:
    """(item_id, item, n, words, seeds): ``item`` tells item texts apart; seeds in order of position."""
    def read(batches):
        for batch in batches:
            for i, j, data, offsets in W.pieces(batch.column(1)):
                h, first = W.word_hashes(data, offsets)
                own = [h[first[k]:first[k + 1]] for k in range(j - i)]
                own_seeds = [W.runs(x, min(tile, len(x))) if len(x) else x for x in own]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i),
                    pa.array([int(W.mix(np.cumsum(x, dtype=np.uint64) * W.U(len(x) * 2 + 1)).sum(dtype=np.uint64).view(np.int64)) for x in own], _I64),
                    pa.array([len(x) for x in own], _I64), pa.array([_blob(x) for x in own], pa.binary()),
                    pa.array([x.view(np.int64) for x in own_seeds], pa.list_(_I64))], names=["item_id", "item", "n", "words", "seeds"])

    kind = benchmark.schema["item_id"].dataType.simpleString()
    return benchmark.select("item_id", "text").mapInArrow(read, f"item_id {kind}, item long, n long, words binary, seeds array<long>")


def bit_filter(keys: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """Bit set of the column's values modulo ``bits``: at most ``bits / 64`` numbers reach the driver."""
    at = F.pmod(F.col(column), F.lit(bits).cast("long"))
    parts = (keys.select(at.alias("b")).groupBy(F.shiftright("b", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("set")).collect())
    out = np.zeros(bits // 64, np.uint64)
    for r in parts:
        out[r["word"]] = np.int64(r["set"]).view(np.uint64)
    return out


def in_filter(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & W.U(len(bits) * 64 - 1)
    return (bits[at >> W.U(6)] >> (at & W.U(63))) & W.U(1) != 0


def _hits(docs: DataFrame, bits: np.ndarray, sizes: list[int], need: int) -> DataFrame:
    """Documents with at least ``need`` places whose run is in the filter: their words and the runs found."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def scan(batches):
        for batch in batches:
            for i, j, data, offsets in W.pieces(batch.column(2)):
                h, first = W.word_hashes(data, offsets)
                found_doc, found_run = [], []
                for size in sizes:
                    s = W.runs(h, size)
                    at = np.flatnonzero(in_filter(shared.value, s))
                    doc = np.searchsorted(first, at, "right") - 1
                    inside = at + size <= first[doc + 1]
                    found_doc.append(doc[inside])
                    found_run.append(s[at[inside]])
                if not found_doc:
                    continue
                doc, run = np.concatenate(found_doc), np.concatenate(found_run)
                keep = np.flatnonzero(np.bincount(doc, minlength=j - i) >= need)
                if len(keep):
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(i + keep)), batch.column(1).take(pa.array(i + keep)),
                        pa.array([_blob(h[first[k]:first[k + 1]]) for k in keep], pa.binary()),
                        pa.array([np.unique(run[doc == k]).view(np.int64) for k in keep], pa.list_(_I64))],
                        names=["doc_id", "text_hash", "doc_words", "runs"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc_id {kind}, text_hash long, doc_words binary, runs array<long>")


def _windows(x: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the free windows of ``size`` words and their Karp-Rabin hashes."""
    power, inverse = W._power_tables(len(x) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * power[:len(x)], dtype=np.uint64)])
    taken = np.concatenate([np.zeros(1, np.int64), np.cumsum(~free)])
    starts = np.arange(len(x) - size + 1)
    starts = starts[taken[starts + size] == taken[starts]]
    return starts, (total[starts + size] - total[starts]) * inverse[starts]


def tiles(item: np.ndarray, doc: np.ndarray, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy tiles (item start, document start, words), longest first; ties by item start, then document start."""
    out: list[tuple[int, int, int]] = []
    if not len(item) or not len(doc):
        return out
    least = min(least, len(item))
    a_free, b_free = np.ones(len(item), bool), np.ones(len(doc), bool)

    def common(size: int):
        if size > min(len(item), len(doc)):
            return None
        (a, ha), (b, hb) = _windows(item, a_free, size), _windows(doc, b_free, size)
        a_in = np.isin(ha, hb)
        return (a[a_in], ha[a_in], b, hb) if a_in.any() else None

    longest = min(len(item), len(doc))
    while common(least):
        low, high = least, longest + 1  # a common run of `low` words exists, none of `high` words
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if common(mid) else (low, mid)
        longest = low
        a, ha, b, hb = common(low)
        order = np.argsort(hb, kind="stable")
        marked = False
        for s, h in zip(a, ha, strict=True):
            if not a_free[s:s + low].all():
                continue
            for k in order[np.searchsorted(hb[order], h, "left"):np.searchsorted(hb[order], h, "right")]:
                d = b[k]
                if b_free[d:d + low].all() and np.array_equal(item[s:s + low], doc[d:d + low]):
                    a_free[s:s + low] = b_free[d:d + low] = False
                    out.append((int(s), int(d), low))
                    marked = True
                    break
        if not marked:  # only equal hashes of different words
            break
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, tile: int = MIN_TILE, coverage: float = MIN_COVERAGE) -> DataFrame:
    """Leaked pairs: doc_id, text_hash, item_id, item_words, covered_words, coverage, n_tiles, tiles (item start:document start:words)."""
    items = stored(_items(benchmark, tile), "bench-items").where("n > 0")
    row = items.agg(F.collect_set(F.least(F.col("n"), F.lit(tile))).alias("sizes"), F.min("n").alias("least")).first()
    texts = items.select("item", "n", "words", "seeds").dropDuplicates(["item", "n"])
    seeds = texts.select("item", "n", F.posexplode("seeds").alias("pos", "run"))
    need = max(1, math.ceil(math.ceil(coverage * (row["least"] or 1) - 1e-9) / tile))
    found = stored(_hits(docs, bit_filter(seeds, "run"), sorted(row["sizes"] or []), need), "bench-hits")
    found = found.withColumn("doc", F.xxhash64("doc_words", "text_hash"))
    unique = found.select("doc", "doc_words", "runs").dropDuplicates(["doc"])
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(p, p + F.least(F.col("n"), F.lit(tile)).cast("int") - 1)))))
    pairs = (unique.select("doc", F.explode("runs").alias("run")).join(seeds, "run")
             .groupBy("doc", "item", "n").agg(F.collect_set("pos").alias("at")).where(covered >= F.col("n") * coverage).select("doc", "item", "n"))
    both = pairs.join(unique.select("doc", "doc_words"), "doc").join(texts.select("item", "n", "words"), ["item", "n"])

    def tile_pairs(frames):
        for f in frames:
            got = [tiles(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), tile) for a, b in zip(f["words"], f["doc_words"], strict=True)]
            yield pd.DataFrame({"doc": f["doc"], "item": f["item"], "n": f["n"], "covered_words": [sum(x[2] for x in t) for t in got],
                                "n_tiles": [len(t) for t in got], "tiles": [",".join(f"{a}:{b}:{n}" for a, b, n in sorted(t)) for t in got]})

    tiled = (both.select("doc", "item", "n", "doc_words", "words")
             .mapInPandas(tile_pairs, "doc long, item long, n long, covered_words long, n_tiles long, tiles string")
             .where(F.col("covered_words") >= F.col("n") * coverage))
    return (tiled.join(items.select("item_id", "item", "n"), ["item", "n"]).join(found.select("doc", "doc_id", "text_hash"), "doc")
            .select("doc_id", "text_hash", "item_id", F.col("n").alias("item_words"), "covered_words",
                    (F.col("covered_words") / F.col("n")).alias("coverage"), "n_tiles", "tiles"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    bad = find_leaks(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"))
    same = rows["_id"].eqNullSafe(bad["_id"]) & (rows["_hash"] == bad["_hash"])
    return rows.join(bad.hint("shuffle_hash"), same, "left_anti").select("_row.*")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")
