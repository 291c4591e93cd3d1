"""Language identification by words, backing off to character n-grams.

A known word (lower-case run of letters) adds its log frequency in every language.  An
unseen word takes the longest n for which any of its character n-grams (word borders
included) is known, and adds the mean log frequency of those.  The language with the
largest sum wins; the score is its softmax share, with sums scaled down to
``SCORE_WORDS`` words so that long texts do not all score 1.

``keep_identified`` keeps a text only on evidence of its own: at least ``MIN_EVIDENCE`` of its words must be known or
hold a known n-gram of ``LONG`` characters or more, and its score must exceed an even share of the languages ``MIN_LEAD`` times.
So scripts and letter salads that were not learned go, however few languages there are.

The classifier is fitted on a bounded sample of labelled rows: the ``MAX_ROWS`` rows with the
smallest id hash, of which the ``MAX_WORDS`` most frequent words and the ``MAX_GRAMS`` most
frequent n-grams of each length are kept.  Every text is scored whole.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is every
text if there is no labelled row; rows with a null id are scored, never learned from;
every input row gives one row; other columns are ignored (``keep_identified`` keeps them).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.sources.tables import table

MAX_ROWS = 10_000
MAX_WORDS, MAX_GRAMS = 50_000, 20_000
LENGTHS = (5, 4, 3, 2, 1)
SCORE_WORDS = 10
MIN_EVIDENCE, LONG, MIN_LEAD = 0.25, 3, 1.2  # of keep_identified
CACHE = 100_000
STEP = 256  # rows whose texts are Python strings at one time

LETTERS = re.compile(r"[^\W\d_]+")


def grams(word: str, n: int) -> list[str]:
    marked = f"\x02{word}\x03" if n > 1 else word
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text is 0 modulo 5 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Model:
    """Log frequencies by feature: ``tables[0]`` of words, ``tables[n]`` of n-grams."""

    def __init__(self, rows: Iterable, langs: list[str]):
        self.langs = langs
        at = {x: k for k, x in enumerate(langs)}
        seen: dict[int, dict[str, np.ndarray]] = {kind: {} for kind in (0, *LENGTHS)}
        for r in rows:
            seen[r["kind"]].setdefault(r["feature"], np.zeros(len(langs)))[at[r["lang"]]] += r["n"]
        self.tables: dict[int, dict[str, int]] = {}
        logs: list[np.ndarray] = []
        for kind, own in seen.items():
            counts = np.array(list(own.values())).reshape(len(own), len(langs))
            base = sum(map(len, logs))
            if kind >= LONG:
                self.long_end = base + len(own)  # n-grams of LONG characters or more have places below
            self.tables[kind] = {f: base + k for k, f in enumerate(own)}
            logs.append(np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * (len(own) + 1))))
        self.logs = np.concatenate(logs) if logs else np.zeros((0, len(langs)))
        self.unseen: dict[str, list[int]] = {}

    def back_off(self, word: str) -> list[int]:
        """The known n-grams of the greatest length that has any."""
        got = self.unseen.get(word)
        if got is None:
            got = []
            for n in LENGTHS:
                get = self.tables[n].get
                got = [k for k in map(get, grams(word, n)) if k is not None]
                if got:
                    break
            if len(self.unseen) >= CACHE:
                self.unseen.clear()
            self.unseen[word] = got
        return got

    def recognises(self, text: str | None) -> bool:
        """Is the language of a text told by enough of its words, and clearly enough?"""
        lang, score = self.predict(text)
        if lang == "und" or len(self.langs) > 1 and score * len(self.langs) < MIN_LEAD:
            return False
        words = LETTERS.findall(text.lower())
        known = self.tables[0]
        told = sum(w in known or bool(got := self.back_off(w)) and got[0] < self.long_end for w in words)
        return told >= MIN_EVIDENCE * len(words)

    def predict(self, text: str | None) -> tuple[str, float]:
        words = LETTERS.findall(text.lower()) if text else []
        if not words or not self.langs:
            return "und", 0.0
        places = list(map(self.tables[0].get, words))
        known = [k for k in places if k is not None]
        total = self.logs[known].sum(axis=0)
        if len(known) < len(words):
            found = [g for g in (self.back_off(w) for w, k in zip(words, places, strict=True) if k is None) if g]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = [k for g in found for k in g]
            total = total + np.repeat(1.0 / sizes, sizes) @ self.logs[flat]
        best = int(total.argmax())
        share = np.exp((total - total[best]) * min(1.0, SCORE_WORDS / len(words)))
        return self.langs[best], float(1.0 / share.sum())


def fit(docs: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Model of the labelled rows that are not held out; what reaches the driver is bounded by the limits above."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    ids = labelled.select(F.col("doc_id").alias("id")).distinct().orderBy(F.xxhash64("id"), "id").limit(max_rows)
    sample = labelled.join(F.broadcast(ids), F.col("doc_id") == F.col("id")).repartition(F.xxhash64("id")).select("lang", "text")

    def count(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                seen: Counter = Counter()
                words: dict[str, Counter] = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words.setdefault(lang, Counter()).update(LETTERS.findall(text.lower()))
                for lang, own in words.items():
                    for w, n in own.items():
                        seen[0, w, lang] = n
                        for size in LENGTHS:
                            for g in grams(w, size):
                                seen[size, g, lang] += n
                kind, feature, lang = zip(*seen, strict=True) if seen else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(feature, pa.string()), pa.array(lang, pa.string()),
                                                  pa.array(list(seen.values()), pa.int64())], names=["kind", "feature", "lang", "n"])

    counts = stored(sample.mapInArrow(count, "kind int, feature string, lang string, n long")
                    .groupBy("kind", "feature", "lang").agg(F.sum("n").alias("n")), "langid-counts")
    kept = []
    for kind in (0, *LENGTHS):
        own = counts.where(F.col("kind") == kind)
        top = own.groupBy("feature").agg(F.sum("n").alias("all")).where("all > 1").orderBy(F.desc("all"), "feature").limit(MAX_GRAMS if kind else MAX_WORDS)
        kept += own.join(F.broadcast(top.select("feature")), "feature").toArrow().to_batches(max_chunksize=STEP)  # columns: a row object each would take far more
    langs = {x for b in kept for x in b.column("lang").unique().to_pylist()}
    return Model((r for b in kept for r in b.to_pylist()), sorted(langs))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def read(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                got = [shared.value.predict(t) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([x[0] for x in got], pa.string()),
                                                  pa.array([x[1] for x in got], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        read, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows whose language is recognised, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index("text")

    def read(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                yield part.filter(pa.array([shared.value.recognises(t) for t in part.column(text_at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(read, docs.schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
