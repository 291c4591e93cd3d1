"""Source divergence audit: how far the sources of a language differ in their words.

Terms are runs of letters A-Z and characters above ASCII, A-Z in lower case.  Inside
``mapInArrow`` a piece of the texts goes through Arrow compute alone: ``ascii_lower``,
``split_pattern_regex``, ``dictionary_encode`` and a hash ``group_by`` give the counts of
(lang, source, term), merged over the task before they leave it.  One shuffle by (lang, term)
adds the partial counts and drops the terms held by too few documents of their language.

The merged table is cut into shards by the hash of the term.  A shard meets the table of its
language's groups, fills a matrix of terms by sources a block of terms at a time, and returns
sums for the pairs of sources and its own leading terms.  Shards are added up afterwards.
All arithmetic is on integers: with p and q two shares in billionths (plus 1), a term adds
floor((p - q)^2 / (p + q)).

Defined cases: null text, lang and source are ''; an empty text counts for its group, which
then has no term; every row is one document, equal rows and ids too; a term of a long text that
is read in pieces counts that document once; ties of a value rank by the item's UTF-8 bytes; a language
with one source has no pairs; with no kept term its pairs are 0; an empty table gives no rows;
other columns are ignored.

Bounds: a task holds ``MERGE_ROWS`` partial rows and one piece of text; a shard about
``SHARD_ROWS`` merged rows and ``CELLS`` matrix cells.  Pairs grow with the square of the sources of a
language, as the result does.  Counts are exact below 10**15.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.common import stored
from tessera.sources.tables import table

MIN_DOCS, TOP = 10, 10
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MERGE_ROWS, SHARD_ROWS, CELLS = 400_000, 100_000, 2_000_000
SLICE_BYTES = 4 << 20
KEYS = ["lang", "source", "term"]
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _slices(data: np.ndarray) -> pa.Array:
    """One long text as strings of about ``SLICE_BYTES``, cut before a character that is in no term."""
    between = np.flatnonzero(~_LETTER[data])
    at = np.searchsorted(between, np.arange(SLICE_BYTES, len(data), SLICE_BYTES))
    cuts = np.unique(np.concatenate([[0], between[at[at < len(between)]], [len(data)]]))
    raw = data.tobytes()
    return pa.array([raw[a:b].decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.string())


def _terms(texts: pa.Array, one_document: bool) -> pa.Table:
    """(row, term, n) of an array of texts; with ``one_document`` all of them are row 0."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=BETWEEN)
    row, term = pc.list_parent_indices(parts), pc.list_flatten(parts)
    some = pc.not_equal(term, "")
    row, term = row.filter(some), term.filter(some).dictionary_encode()
    if one_document:
        row = pa.array(np.zeros(len(row), np.int64))
    got = pa.table({"row": row, "code": term.indices}).group_by(["row", "code"]).aggregate([([], "count_all")])
    return pa.table({"row": got["row"], "term": pc.take(term.dictionary, got["code"]), "n": got["count_all"]})


def _merged(tables: list[pa.Table]) -> pa.Table:
    got = pa.concat_tables(tables).group_by(KEYS).aggregate([("n", "sum"), ("docs", "sum")])
    return got.select([*KEYS, "n_sum", "docs_sum"]).rename_columns([*KEYS, "n", "docs"])


def partial_counts(batches):
    """(lang, source, term, n, docs) of a task's (text, lang, source) rows; a group without terms has the term ''."""
    held, rows = [], 0
    for batch in batches:
        text, lang, source = (pc.fill_null(batch.column(k), "") for k in range(3))
        held.append(pa.table({"lang": lang, "source": source, "term": pa.array([""] * len(lang), pa.string()),
                              "n": pa.array(np.zeros(len(lang), np.int64)), "docs": pa.array(np.zeros(len(lang), np.int64))}))
        rows += len(lang)
        for i, j, data, _ in W.pieces(text, SLICE_BYTES):
            long = j - i == 1 and len(data) > SLICE_BYTES
            if long:  # slice by slice, then added up: a document counts once for a term
                got = pa.concat_tables([_terms(s, True) for s in (x.slice(k, 1) for x in (_slices(data),) for k in range(len(x)))])
                got = got.group_by(["row", "term"]).aggregate([("n", "sum")]).rename_columns(["row", "term", "n"])
            else:
                got = _terms(text.slice(i, j - i), False)
            at = pc.add(pc.cast(got["row"], pa.int64()), i)
            part = pa.table({"lang": pc.take(lang, at), "source": pc.take(source, at), "term": got["term"], "n": pc.cast(got["n"], pa.int64())})
            part = part.group_by(KEYS).aggregate([("n", "sum"), ("n", "count")]).select([*KEYS, "n_sum", "n_count"])
            held.append(part.rename_columns([*KEYS, "n", "docs"]))
            rows += len(part)
            if rows > MERGE_ROWS:
                held = [_merged(held)]
                rows = len(held[0])
                if rows > MERGE_ROWS // 2:
                    yield from held[0].to_batches()
                    held, rows = [], 0
    if held:
        yield from _merged(held).to_batches()


def term_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, n, lang_n) of the kept terms, and a row with the term '' for every (lang, source)."""
    parts = docs.select(*[F.col(c).cast("string").alias(c) for c in ("text", "lang", "source")]).mapInArrow(
        partial_counts, "lang string, source string, term string, n long, docs long")
    own = Window.partitionBy("lang", "term")
    counts = (parts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
              .select(*KEYS, "n", F.sum("n").over(own).alias("lang_n"), F.sum("docs").over(own).alias("lang_docs")))
    return counts.where((F.col("lang_docs") >= min_docs) | (F.col("term") == "")).drop("lang_docs")


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10**9 * (count + 2) / total), three decimal digits at a time so that 64 bits suffice."""
    high, rest = np.divmod((count + 2) * 1000, total)
    middle, rest = np.divmod(rest * 1000, total)
    return 1 + high * 1_000_000 + middle * 1000 + rest * 1000 // total


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _strings(values) -> pa.Array:
    return pa.array(values, pa.string())


def shard_divergence(key, terms: pa.Table, groups: pa.Table) -> pa.Table:
    """(lang, source, part, item, value) of one shard of a language: sums of its pairs, its leading terms."""
    lang = key[0].as_py()
    names = groups["source"].to_pylist()
    total, lang_total = groups["total"].to_numpy(), groups["lang_total"].to_numpy()[0]
    out = {"source": [], "part": [], "item": [], "value": []}
    sums = np.zeros((len(names), len(names)), np.int64)
    if len(terms):
        coded = terms["term"].combine_chunks().dictionary_encode()
        words = coded.dictionary
        rank = np.empty(len(words), np.int64)
        rank[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
        word = rank[coded.indices.to_numpy()]
        place = pc.index_in(terms["source"].combine_chunks(), value_set=_strings(names)).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(word, kind="stable")
        word, place = word[order], place[order]
        n, lang_n = terms["n"].to_numpy()[order], terms["lang_n"].to_numpy()[order]
        step = max(1, CELLS // len(names))
        for low in range(0, len(words), step):
            a, b = np.searchsorted(word, [low, low + step])
            counts = np.zeros((min(step, len(words) - low), len(names)), np.int64)
            counts[word[a:b] - low, place[a:b]] = n[a:b]
            p = share(counts, total[None, :])
            for s in range(len(names) - 1):
                sums[s, s + 1:] += gap(p[:, s:s + 1], p[:, s + 1:]).sum(axis=0)
        p, q = share(n, total[place]), share(lang_n, lang_total)
        over = np.flatnonzero((n > 0) & (p > q))
        value = gap(p[over], q[over])
        best = np.lexsort((word[over], -value, place[over]))
        group = place[over][best]
        nth = np.arange(len(group)) - np.searchsorted(group, group)
        best = best[nth < TOP]
        texts = words.take(pa.array(np.argsort(rank)[word[over][best]])).to_pylist()
        out["source"] += [names[k] for k in place[over][best]]
        out["part"] += ["term"] * len(best)
        out["item"] += texts
        out["value"] += value[best].tolist()
    sums += sums.T
    for s, source in enumerate(names):
        others = [t for t in range(len(names)) if t != s]
        out["source"] += [source] * len(others)
        out["part"] += ["pair"] * len(others)
        out["item"] += [names[t] for t in others]
        out["value"] += sums[s, others].tolist()
    return pa.table({"lang": _strings([lang] * len(out["source"])), "source": _strings(out["source"]), "part": _strings(out["part"]),
                     "item": _strings(out["item"]), "value": pa.array(out["value"], pa.int64())})


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank): every other source of the language, and the ``TOP`` terms above its share."""
    counts = stored(term_counts(docs, min_docs), "divergence-counts")
    shards = counts.count() // SHARD_ROWS + 1
    some = counts.where("term <> ''")
    totals = some.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = some.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count("*").alias("v"))
    groups = (counts.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["n", "lang_n", "v"])
              .select(F.col("lang").alias("lang"), F.col("source").alias("source"), (F.col("n") + 2 * F.col("v")).alias("total"), (F.col("lang_n") + 2 * F.col("v")).alias("lang_total"),
                      F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")))
    left = some.withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int"))
    parts = left.groupBy("lang", "shard").cogroup(groups.groupBy("lang", "shard")).applyInArrow(
        shard_divergence, "lang string, source string, part string, item string, value long")
    sums = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    nth = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return sums.withColumn("rank", nth).where((F.col("part") == "pair") | (F.col("rank") <= TOP))


def divergence_sql(min_docs: int = MIN_DOCS) -> str:
    """The same rows from DuckDB."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= {min_docs}),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
m AS (SELECT lang, source, sum(c.n) AS n FROM c JOIN k USING (lang, term) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // (coalesce(m.n, 0) + 2 * v.v) AS p,
             1 + CAST(1000000000 AS HUGEINT) * (k.n + 2) // (v.n + 2 * v.v) AS q
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN m ON m.lang = g.lang AND m.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= {TOP}
"""


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))
