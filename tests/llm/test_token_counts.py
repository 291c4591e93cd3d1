"""Token counts against the tokenizer itself."""

import random
from collections import Counter

import pytest

from tessera.llm import token_counts as TC

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, tokens string, chunk long, n_bytes long"


def description(name=TC.TOKENIZER):
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def table(spark, texts, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], t, "en", "x", 7, 7) for i, t in enumerate(texts)], DOCS)


def sample_texts():
    rng = random.Random(5)
    plain = [chr(i) for i in range(0x180)]
    wide = plain + [chr(rng.randrange(0x180, 0xD7FF)) for _ in range(500)] + [chr(rng.randrange(0x10000, 0x1FFFF)) for _ in range(100)]
    texts = ["", " ", "\n\t", "x" * 3000, "it's we'LL <|endoftext|><|startoftext|> <|ENDOFTEXT|> |endoftext|>", "ΣΑΣ İstanbul ǅ ﬁ é é"]
    texts += [f"{c}a{c}{c}1'{c}S" for c in plain]
    for alphabet in (plain, wide, [*"abc '\"st1 \n<|>"]):
        texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 80))) for _ in range(300)]
    return texts


@pytest.mark.parametrize("name", [TC.TOKENIZER, "byte_bpe_50k.json"])
def test_counts_match_the_library(spark, name, monkeypatch):
    from tokenizers import Tokenizer
    monkeypatch.setattr(TC, "CHUNK_BYTES", 5000)  # many chunks share pre-tokens
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    texts = sample_texts()
    rows = TC.token_counts(table(spark, texts), description(name), 20).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = len(tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (want, len(texts[r.doc_id].encode()), want > 20)


def test_nulls_repeats_and_long_text(spark):
    long = "the cat's 42 hats, and l'été. " * 60_000  # 1.8 MB
    rows = TC.token_counts(table(spark, [None, "", "a b", "a b", long, "a b"], [1, 2, 3, 3, None, 4]), description()).collect()
    one = len(TC.load(description()).tokenizer.encode("the cat's 42 hats, and l'été. ", add_special_tokens=False).ids)
    assert Counter((r.doc_id, r.n_tokens, r.n_bytes, r.over_limit) for r in rows) == Counter(
        {(1, 0, 0, False): 1, (2, 0, 0, False): 1, (3, 2, 3, False): 2, (4, 2, 3, False): 1, (None, one * 60_000, len(long.encode()), True): 1})


def test_empty_table(spark):
    assert TC.token_counts(table(spark, []), description()).collect() == []


def test_each_pre_token_is_counted_once_where_equal_ones_meet(spark, monkeypatch):
    monkeypatch.setattr(TC, "CHUNK_BYTES", 10)
    docs = table(spark, ["alpha beta alpha", "beta gamma", "alpha"] * 40)
    chunks = TC._chunks(docs, spark.sparkContext.broadcast(description()))
    rows = chunks.select("tokens").collect()
    assert all(len(set(r.tokens)) == len(r.tokens) for r in rows) and len(rows) > 20
    assert {r.n_tokens for r in TC.token_counts(docs, description()).collect()} == {1, 2, 3}


def test_tokens_searched_in_normalised_text_are_refused():
    import json
    spec = json.loads(description())
    spec["added_tokens"][0]["normalized"] = True
    with pytest.raises(ValueError):
        TC.Cutter(json.dumps(spec))
