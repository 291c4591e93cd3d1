"""Source divergence against plain Python integers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import divergence as D
from tests.oracle import compare, duck_connect
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, term string, n long, docs long, total long"


def table(spark, rows):
    return spark.createDataFrame([(i, *r, "t", 1, 2, 3) for i, r in enumerate(rows)], DOCS)


def brute(rows, min_docs):
    n, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        n[lang, source].update(words)
        held[lang].update(set(words))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, k in held[lang].items() if k >= min_docs]
        v = len(kept)
        whole = Counter()
        for s in sources:
            whole.update(n[lang, s])

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * v) for t in kept}

        p, q = {s: shares(n[lang, s]) for s in sources}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, 10)):
                for rank, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.add((lang, s, part, item, value, rank))
    return out


def rows_of(frame):
    rows = [(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("shard_rows", [D.SHARD_ROWS, 7])
def test_matches_plain_integers(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(D, "SHARD_ROWS", shard_rows)
    rng = random.Random(3)
    words = ["a", "B", "Été", "日本", "x1y", "the", "THE", "ſ", "İ", "\x7f", "_z_", "q" * 30, "-"]
    rows = [("".join(rng.choice(words) + rng.choice([" ", "", ",", "\n", "0", "\x00"]) for _ in range(rng.randint(0, 12))),
             rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "é", None, "S"])) for _ in range(300)]
    rows += [(None, "en", "only null"), ("", "xx", "alone"), ("rare words here", "yy", "a"), ("other", "yy", "b")]
    assert rows_of(D.divergence(table(spark, rows), 4)) == brute(rows, 4)


def test_small_slices_merges_and_blocks(spark, monkeypatch):
    for name, value in (("SLICE_BYTES", 50), ("MERGE_ROWS", 20), ("CELLS", 3)):
        monkeypatch.setattr(D, name, value)
    rng = random.Random(4)
    rows = [(" ".join(rng.choices(["red", "green", "blue", "vert", "été" * 9], k=rng.randint(0, 40))), "fr", rng.choice("abc")) for _ in range(60)]
    parts = list(D.partial_counts(table(spark, rows).select("text", "lang", "source").toArrow().to_batches()))
    assert sum(sum(b.column(3).to_pylist()) for b in parts) == sum(len(r[0].split()) for r in rows)
    assert sum(sum(b.column(4).to_pylist()) for b in parts) == sum(len(set(r[0].split())) for r in rows)
    assert rows_of(D.divergence(table(spark, rows), 2)) == brute(rows, 2)


def test_long_text_and_ties(spark):
    long = "alpha beta, " * 100_000  # 1.2 MB
    rows = [(long, "en", "a"), *[("alpha beta gamma", "en", s) for s in "bcd" for _ in range(10)]]
    got = rows_of(D.divergence(table(spark, rows)))
    assert got == brute(rows, 10)
    same = sorted((r[5], r[3]) for r in got if r[:3] == ("en", "b", "pair") and r[3] in "cd")
    assert [x[1] for x in same] == ["c", "d"]


def test_empty_table(spark):
    assert D.divergence(table(spark, [])).collect() == []


def test_large_counts_are_exact():
    counts, total = np.array([0, 12_345_678_901_234, 999_999_999_999_998]), np.array([10**15])
    assert D.share(counts, total).tolist() == [1 + 10**9 * (int(c) + 2) // 10**15 for c in counts]


def test_sql(spark):
    got = compare(D.op12_source_divergence(spark, SF_SMALL), duck_connect(SF_SMALL).sql(D.divergence_sql()))
    assert got["values_match"], got
