"""The pipeline stage by stage against brute force."""

import binascii
import importlib
import re

import pytest

from tessera.llm import decontaminate, language_id, mixing
from tests.conftest import SF_SMALL
from tests.llm.test_dedup import brute_components, brute_tiles, words


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        from tessera.llm.common import stored
        after = stored(stage(spark, docs, SF_SMALL), f"test-{name}")
        out.append((docs, after))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
        docs = after
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_language(spark, stages):
    before, after = stages[0]
    model = language_id.fit(before)

    def recognised(text):
        lang, score = model.predict(text)
        if lang == "und" or score * len(model.langs) < 1.2:
            return False
        words = re.findall(r"[^\W\d_]+", text.lower())
        long = [{w[k:k + n] for k in range(len(w)) for n in (3, 4, 5)} for w in (f"\x02{w}\x03" for w in words)]
        known = {g for n in (3, 4, 5) for g in model.tables[n]}
        return sum(w in model.tables[0] or bool(own & known) for w, own in zip(words, long, strict=True)) >= len(words) / 4

    assert sorted(i for i, _ in rows(after)) == sorted(i for i, t in rows(before) if recognised(t))


def test_one_of_each_group(stages):
    before, after = (rows(x) for x in stages[1])
    want, _ = brute_components([t for _, t in before], [i for i, _ in before], 5, 80)
    assert sorted(i for i, _ in after) == sorted(i for (i, t), c in zip(before, want, strict=True) if i == c)


def test_leaks(spark, stages):
    before, after = (rows(x) for x in stages[2])
    items = [words(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    clean = []
    for i, t in before:
        w = words(t)
        places = set(w)
        leaked = any(sum(x in places for x in it) >= 0.8 * len(it) and sum(x[2] for x in brute_tiles(it, w, decontaminate.MIN_TILE)) >= 0.8 * len(it) for it in items if it)
        clean += [] if leaked else [i]
    assert sorted(i for i, _ in after) == sorted(clean)


def test_mix(spark, stages):
    before, after = stages[3]
    copies = {r.doc_id: r.copies for r in mixing.mix(before, spark.read.parquet(f"{SF_SMALL}/labels.parquet")).collect()}
    assert sorted(i for i, _ in rows(after)) == sorted(i for i, n in copies.items() for _ in range(n))


def test_shards(stages):
    before, after = stages[4]
    got = after.collect()
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got) == sorted((i, len(t.encode()) + 1, binascii.crc32(t.encode())) for i, t in rows(before))


def test_run_is_the_stages(spark, stages):
    import corpus_pipeline
    key = lambda r: (r.doc_id, r.shard, r.slot, r.virtual_slot)
    assert sorted(map(key, corpus_pipeline.run(spark, SF_SMALL).collect())) == sorted(map(key, stages[-1][1].collect()))


def test_extra_columns_and_empty_table(spark):
    import corpus_pipeline
    kinds = "doc_id long, text string, lang string, source string, n_chars long, _id string, _hash string, n string, row string, copies string, shard string"
    texts = ["the dog and the cat ran over the hill", "the dog and the cat ran over the hill", None, "", "eins zwei drei vier fuenf sechs"]
    for data in ([], [(i, t, "en", "s", 1, "a", "b", "c", "d", "e", "f") for i, t in enumerate(texts)]):
        docs = spark.createDataFrame(data, kinds)
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, SF_SMALL)
            assert name == "sharding" or after.columns == docs.columns
            docs = spark.createDataFrame(after.collect(), after.schema)
        assert docs.count() == (2 if data else 0)


def test_registered(spark):
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert "pipeline" in names and sorted(int(x[2:].split("_")[0]) for x in names if x.startswith("op")) == list(range(1, 14))
