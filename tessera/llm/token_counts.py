"""Token counts of whole texts without their token ids.

A text is cut into pre-tokens as the tokenizer cuts it, and a pre-token's pieces do not depend on its
neighbours.  So each distinct pre-token is given to the tokenizer's model once, and a document's
count is the sum of its pre-tokens' frequencies times their pieces.

1. Tasks gather documents into chunks of ``CHUNK_BYTES`` of text.  A chunk holds its distinct pre-tokens and,
   as compressed numbers, every document's pre-tokens and frequencies.  Chunks are written once.
2. The distinct pre-tokens of all chunks are shuffled and sorted by pre-token, so equal ones follow each
   other: the model counts one of them, and (chunk, place, pieces) goes back to the chunk.
3. A chunk meets its piece counts and gives one row per document.

Only what the chunks share is shuffled: no text and no row per document and pre-token.  A pre-token
of every document has one row per chunk.

Texts are normalised and cut by the tokenizer's own parts.  Where these are the ones in ``KNOWN`` and a
text holds nothing beyond U+017F, one regular expression does the same faster: such characters have
no compositions, lower-case alone, and are letters, digits or neither since Unicode 6.1.

Defined cases: null text is the empty text, of no bytes and no tokens; special strings inside texts are one token
each, as by the library's default; nothing is added, cut off or padded; every row gives one row, equal
rows and ids too; an empty table gives no rows; other columns are ignored.  Added tokens that are
searched in the normalised text or take white space with them raise ValueError.
"""

from __future__ import annotations

import json
import re
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.sources.tables import table

TOKENIZER, LIMIT = "word_bpe_49k.json", 2048
CHUNK_BYTES = 16 << 20
# The normaliser and the pattern of the tokenizer whose texts are cut by PLAIN
KNOWN = (["NFC", ("Replace", r"\s+", " "), "Lowercase"], r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_LETTERS, _DIGITS, _WHITE = "a-zªµºß-öø-ſ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
PLAIN = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_DIGITS}]|[^{_WHITE}{_DIGITS}{_LETTERS}]+")
BEYOND = re.compile("[^\x00-ſ]")
_CHUNK = "chunk long, ids array<{}>, n_bytes array<long>, extra array<long>, tokens array<string>, sizes binary, places binary, counts binary"


def _is_known(spec: dict) -> bool:
    try:
        norm = [x["type"] if x["type"] != "Replace" else ("Replace", x["pattern"]["Regex"], x["content"]) for x in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        return (norm == KNOWN[0] and split["pattern"] == {"Regex": KNOWN[1]} and (split["behavior"], split["invert"]) == ("Removed", True)
                and level["type"] == "ByteLevel" and not level["add_prefix_space"] and not level["use_regex"])
    except (KeyError, TypeError, ValueError):
        return False


class Cutter:
    """Pre-tokens of texts, as the tokenizer of a JSON description gives them to its model."""

    def __init__(self, description: str):
        from tokenizers import Tokenizer, pre_tokenizers
        spec = json.loads(description)
        self.tokenizer = Tokenizer.from_str(description)
        self.plain = _is_known(spec)
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        added = spec.get("added_tokens") or []
        if any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in added):
            raise ValueError("added tokens must be plain strings of the text itself")
        names = sorted((re.escape(x["content"]) for x in added), key=len, reverse=True)
        self.special = re.compile("|".join(names)) if names else None

    def byte_level(self, token: str) -> str:
        return token if token.isascii() and token.isprintable() else self.as_bytes.pre_tokenize_str(token)[0][0]

    def cut(self, text: str) -> tuple[Counter, Counter, int]:
        """Frequencies of pre-tokens cut by ``PLAIN`` (still text), of the others (as the model reads them), and special strings."""
        plain, other, extra = Counter(), Counter(), 0
        parts = [text]
        if self.special and self.special.search(text):
            extra = len(self.special.findall(text))
            parts = self.special.split(text)
        for part in parts:
            if self.plain and not BEYOND.search(part):
                plain.update(PLAIN.findall(part.lower()))
            else:
                if self.tokenizer.normalizer:
                    part = self.tokenizer.normalizer.normalize_str(part)
                cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(part) if self.tokenizer.pre_tokenizer else [(part, None)] * bool(part)
                other.update(x[0] for x in cut)
        return plain, other, extra

    def pieces(self, token: str) -> int:
        return len(self.tokenizer.model.tokenize(token))


@lru_cache(maxsize=2)
def load(description: str) -> Cutter:
    """Once for a worker, not for a task."""
    return Cutter(description)


class _Chunk:
    """Documents of a chunk under construction."""

    def __init__(self, cutter: Cutter):
        self.cutter, self.index = cutter, defaultdict()
        self.index.default_factory = self.index.__len__
        chunk = self

        class Plain(dict):
            def __missing__(self, token):
                self[token] = place = chunk.index[cutter.byte_level(token)]
                return place

        self.plain = Plain()
        self.ids, self.n_bytes, self.extra, self.sizes, self.places, self.counts, self.read = [], [], [], [], [], [], 0

    def add(self, doc_id, text: str, n_bytes: int) -> None:
        plain, other, extra = self.cutter.cut(text)
        self.places += [self.plain[x] for x in plain] + [self.index[x] for x in other]
        self.counts += [*plain.values(), *other.values()]
        self.sizes.append(len(plain) + len(other))
        self.ids.append(doc_id)
        self.n_bytes.append(n_bytes)
        self.extra.append(extra)
        self.read += n_bytes

    def batch(self, number: int, schema: pa.Schema) -> pa.RecordBatch:
        places, counts = np.array(self.places, np.int32), np.array(self.counts, np.int64)
        order = np.lexsort((places, np.repeat(np.arange(len(self.sizes)), self.sizes)))
        places, counts = places[order], counts[order]
        blobs = [_packed(x) for x in (np.array(self.sizes, np.int32), np.diff(places, prepend=np.int32(0)), counts)]
        row = [number, self.ids, self.n_bytes, self.extra, list(self.index), *blobs]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, schema.types, strict=True)], schema=schema)


def _packed(numbers: np.ndarray) -> bytes:
    """Compressed little-endian bytes, the low bytes of all numbers first."""
    width = numbers.dtype.itemsize
    planes = numbers.astype(f"<i{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(blob: bytes, dtype) -> np.ndarray:
    planes = pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def _chunks(docs: DataFrame, shared) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def read(batches):
        cutter, number, chunk = load(shared.value), TaskContext.get().partitionId() << 32, None
        for batch in batches:
            schema = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(batch.schema.types[0])), ("n_bytes", pa.list_(pa.int64())), ("extra", pa.list_(pa.int64())),
                                ("tokens", pa.list_(pa.string())), *((x, pa.binary()) for x in ("sizes", "places", "counts"))])
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0)
            for doc_id, text, n in zip(batch.column(0), batch.column(1), sizes, strict=True):
                chunk = chunk or _Chunk(cutter)
                chunk.add(doc_id.as_py(), text.as_py() or "", n.as_py())
                if chunk.read >= CHUNK_BYTES:
                    yield chunk.batch(number, schema)
                    number, chunk = number + 1, None
        if chunk:
            yield chunk.batch(number, schema)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(read, _CHUNK.format(kind))


def _piece_counts(chunks: DataFrame, shared) -> DataFrame:
    """(chunk, place, pieces) of the chunks' distinct pre-tokens, each counted where equal ones meet."""
    def count(batches):
        cutter, last = load(shared.value), {}
        for batch in batches:
            coded = batch.column(2).dictionary_encode()
            names = coded.dictionary.to_pylist()
            pieces = [last[x] if x in last else cutter.pieces(x) for x in names]
            if names:  # sorted: only the last one goes on in the next batch
                last = {names[-1]: pieces[-1]}
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pc.take(pa.array(pieces, pa.int64()), coded.indices)], names=["chunk", "place", "pieces"])

    tokens = chunks.select("chunk", F.posexplode("tokens").alias("place", "token"))
    return tokens.repartition("token").sortWithinPartitions("token").mapInArrow(count, "chunk long, place int, pieces long")


def _sums(key, chunk: pa.Table, counted: pa.Table) -> pa.Table:
    """(doc_id, n_bytes, n_tokens) of the documents of one chunk."""
    row = {name: chunk[name][0] for name in chunk.column_names}
    pieces = np.zeros(len(counted), np.int64)
    pieces[counted["place"].to_numpy()] = counted["pieces"].to_numpy()
    sizes, steps, counts = (_unpacked(row[x].as_py(), t) for x, t in (("sizes", np.int32), ("places", np.int32), ("counts", np.int64)))
    upto = np.concatenate([[0], np.cumsum(pieces[np.cumsum(steps, dtype=np.int64)] * counts)])
    ends = np.cumsum(sizes, dtype=np.int64)
    n = upto[ends] - upto[ends - sizes] + row["extra"].values.to_numpy()
    return pa.table({"doc_id": row["ids"].values, "n_bytes": row["n_bytes"].values, "n_tokens": pa.array(n)})


def token_counts(docs: DataFrame, description: str, limit: int = LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit.  ``description`` is a tokenizer's JSON, some megabytes, which is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(description)
    chunks = stored(_chunks(docs, shared), "token-chunks")
    counted = _piece_counts(chunks.select("chunk", "tokens"), shared)
    rows = chunks.select(*[F.col(c).alias(c) for c in ("chunk", "ids", "n_bytes", "extra", "sizes", "places", "counts")])
    kind = docs.schema["doc_id"].dataType.simpleString()
    got = rows.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(_sums, f"doc_id {kind}, n_bytes long, n_tokens long")
    return got.withColumn("over_limit", F.col("n_tokens") > limit)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as f:  # on the driver only
        description = f.read()
    return token_counts(table(spark, sf_dir, "documents"), description)
