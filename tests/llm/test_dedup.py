"""Near-duplicates and benchmark leaks against brute force on small tables."""

import random
import re

import numpy as np
import pytest

from tessera.llm import decontaminate, near_dedup
from tessera.llm import words as W

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, n string"


def table(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "en", "src0", len(t or ""), "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, size=3):
    w = words(text)
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute_components(texts, ids, size=3, percent=85):
    sets = [shingles(t, size) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    parent[root(i)] = root(j)
    best = {}
    for i in range(len(texts)):
        r = root(i)
        best[r] = min(best.get(r, 1 << 70), ids[i])
    return [best[root(i)] for i in range(len(texts))], [len(s) for s in sets]


def near_texts(seed, groups=25, size=40):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefg", k=rng.randint(2, 5)))
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([1, 2, 3, 6, 12, size, 4 * size]))]
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(rng.choice([" ", "\n", " \t"]).join(copy))
    texts += [None, "", "  ", "the\x0bTHE\x1cx é"] + [texts[0]] * 30
    rng.shuffle(texts)
    return texts


def test_words_match_regex():
    import pyarrow as pa
    texts = ["A b\tC", None, "", "\n\n", "é\x1cÉ x  y", "a" * 5000 + " b", "tail "]
    seen = {}
    for i, j, data, offsets in W.pieces(pa.array(texts), limit=8):
        h, first = W.word_hashes(data, offsets)
        for k in range(i, j):
            own, want = h[first[k - i]:first[k - i + 1]], words(texts[k])
            assert len(own) == len(want)
            for x, w in zip(own, want, strict=True):
                assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_match_brute_force(spark, seed):
    texts = near_texts(seed)
    ids = list(range(100, 100 + len(texts)))
    random.Random(seed).shuffle(ids)
    want, sizes = brute_components(texts, ids)
    got = {r.doc_id: r for r in near_dedup.near_duplicates(table(spark, texts, ids)).collect()}
    assert [got[i].n_shingles for i in ids] == sizes
    assert [got[i].component_id for i in ids] == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_chain_through_buckets_without_a_shared_centre(spark):
    rng = random.Random(3)
    base = [f"w{rng.random()}" for _ in range(400)]
    texts = []
    for k in range(40):  # neighbours are links, far ones are not
        base[(k * 10) % 400] = f"x{k}"
        texts.append(" ".join(base))
    ids = list(range(40))
    rng.shuffle(ids)
    want, _ = brute_components(texts, ids)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(table(spark, texts, ids)).collect()}
    assert [got[i] for i in ids] == want


def test_small_buckets_are_compared_in_full(spark):
    """Groups that share most words, each of three links, in common buckets."""
    rng = random.Random(4)
    common = [f"c{i}" for i in range(120)]
    texts = [" ".join(common + [f"u{g}_{i}" for i in range(30)] + ([f"v{k}"] if k else [])) for g in range(3) for k in range(3)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    want, _ = brute_components(texts, ids)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(table(spark, texts, ids)).collect()}
    assert [got[i] for i in ids] == want


def test_many_groups_in_common_buckets(spark):
    """More groups than the hubs of a bucket can reach."""
    rng = random.Random(4)
    common = [f"c{i}" for i in range(120)]
    texts = [" ".join(common + [f"u{g}_{i}" for i in range(30)] + ([f"v{k}"] if k else [])) for g in range(8) for k in range(3)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    want, _ = brute_components(texts, ids)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(table(spark, texts, ids)).collect()}
    assert [got[i] for i in ids] == want


@pytest.mark.parametrize("block", [2000, 7])
def test_pairs_inside_a_crowd_below_the_threshold(spark, monkeypatch, block):
    """Hundreds of edits of one template, most of similarity 0.8, of which some have a near copy."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(300):
        edit = list(base)
        for j in rng.sample(range(200), 4):
            edit[j] = f"x{k}_{j}"
        texts.append(" ".join(edit))
        if k % 3 == 0:
            edit[rng.randrange(200)] = f"y{k}"
            texts.append(" ".join(edit[rng.randint(0, 1):]))
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    want, _ = brute_components(texts, ids)
    assert 250 <= len(set(want)) <= 300
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(table(spark, texts, ids)).collect()}
    assert [got[i] for i in ids] == want


def test_large_group_of_near_copies(spark):
    """Copies with a few changed words link to their source, not to each other."""
    rng = random.Random(12)
    base = [f"w{rng.random()}" for _ in range(150)]
    texts = [" ".join(base)]
    for _ in range(250):
        copy = list(base)
        for _ in range(rng.randint(1, 4)):
            copy[rng.randrange(150)] = f"x{rng.random()}"
        texts.append(" ".join(copy))
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    want, _ = brute_components(texts, ids)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(table(spark, texts, ids)).collect()}
    assert [got[i] for i in ids] == want


def test_null_ids_and_repeated_rows(spark):
    texts = ["a b c d e"] * 3 + ["q r s t u v", "q r s t u v", None, ""]
    ids = [None, 5, 9, None, None, None, 7]
    out = near_dedup.near_duplicates(table(spark, texts, ids)).collect()
    assert len(out) == 7
    assert sorted(str(r.component_id) for r in out) == sorted(["5", "5", "5", "None", "None", "None", "7"])
    kept = near_dedup.one_per_group(table(spark, ["a b c d e"] * 4 + ["z"], [1, 1, 2, 3, 8]))
    assert kept.columns == table(spark, []).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 8]


def test_empty(spark):
    none = table(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    assert near_dedup.near_duplicates(none).count() == 0
    assert decontaminate.find_leaks(none, bench).count() == 0
    assert decontaminate.find_leaks(table(spark, ["a b c d e f", None]), bench).count() == 0
    assert decontaminate.without_leaks(table(spark, ["a b c d e f", None]), bench).count() == 2


def brute_tiles(a, b, least):
    least = min(least, len(a))
    fa, fb, out = [True] * len(a), [True] * len(b), []
    while True:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and fa[i + k] and fb[j + k] and a[i + k] == b[j + k]:
                    k += 1
                if k >= least and (best is None or k > best[2]):
                    best = (i, j, k)
        if best is None:
            return out
        i, j, k = best
        fa[i:i + k] = fb[j:j + k] = [False] * k
        out.append(best)


@pytest.mark.parametrize("seed", range(6))
def test_tiles_match_brute_force(seed):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 4, 40).astype(np.uint64)
    b = np.concatenate([rng.integers(0, 4, 30), a[20:35], rng.integers(0, 4, 10), a[3:14]]).astype(np.uint64)
    assert decontaminate.tiles(a, b, 3) == brute_tiles(a.tolist(), b.tolist(), 3)
    assert decontaminate.tiles(a[:2], b, 5) == brute_tiles(a[:2].tolist(), b.tolist(), 5)


def test_leaks_match_brute_force(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdef", k=3))
    items = [[word() for _ in range(n)] for n in (2, 4, 5, 9, 15, 30, 30, 59)]
    items.append(items[5])
    texts = []
    for it in items:
        cut = len(it) // 2
        filler = [word() for _ in range(50)]
        texts += [" ".join(filler + it + filler), " ".join(it[cut:] + filler + it[:cut]), " ".join(filler + it[:max(1, cut)]),
                  " ".join(x.upper() for x in it), " ".join(filler)]
    texts += [None, ""]
    want = set()
    for d, t in enumerate(texts):
        for k, it in enumerate(items):
            covered = sum(x[2] for x in brute_tiles(it, words(t), 5))
            if words(t) and covered >= 0.8 * len(it):
                want.add((d, k, covered))
    bench = spark.createDataFrame([(k, " ".join(it)) for k, it in enumerate(items)] + [(98, None), (99, "")], "item_id long, text string")
    out = decontaminate.find_leaks(table(spark, texts), bench).collect()
    assert {(r.doc_id, r.item_id, r.covered_words) for r in out} == want and len(out) == len(want)
    clean = decontaminate.without_leaks(table(spark, texts), bench)
    assert clean.columns == table(spark, []).columns
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, _, _ in want}
