"""Near-duplicate removal by one-permutation MinHash.

Every document's distinct word shingles are hashed once.  The top bits of a hash choose one
of ``BINS`` bins and the smallest hash of a bin is its value; an empty bin takes the value
of the first non-empty bin in an order of its own (optimal densification).  Bands of bins
give bucket keys.

Documents with equal shingle sets form one class, represented by the smallest id, so copies
never meet as pairs.  In a bucket, members are compared with its hub (a star), not with each
other.  A member's degree is the sum of the sizes of its buckets, so the text closest to all others of a
group, such as the one they were copied from, has the largest degree and is the hub.
Components are formed from the links found.  Members of buckets whose other members lie in several components are then
joined exactly: pairs of different components that share a rare shingle, one that several components hold, within the
prefixes that the threshold and the set sizes allow.  So the pairs of the hubs grow with the members of the
buckets, not with their square, and no pair of a bucket is left out.  A pair whose signatures rule out the threshold by five standard errors, or whose
set sizes do, is not a link; all other pairs are confirmed on their full sets.

Defined cases: documents without words have an empty set and are linked with nothing; fewer
words than a shingle give one shingle; rows with one id are one node (its component is that
of any of its texts); a row with a null id takes part under a stand-in id of its set above
all real ids, and its ``component_id`` is null if no real id is reachable; empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.common import stored
from tessera.llm.decontaminate import bit_filter, in_filter
from tessera.sources.tables import table

BINS = 128
SHINGLE, MIN_PERCENT, ROWS = 3, 85, 5
NODE_BITS = 1 << 24
STAND_IN = 1 << 62
COUNTERS = 1 << 20  # counts of shingles of the exact join, shared by hash: they only set an order and a number of blocks
BLOCK = 2000  # rows of a shingle that meet in one block
STEP = 512  # sets whose prefixes are made at one time

_rng = np.random.default_rng(7)
_ORDER = np.argsort(_rng.random((BINS, BINS)), axis=1)
_EDGES = np.arange(1, BINS, dtype=np.uint64) << W.U(57)
_SET = [W.U(int(x) | 1) for x in _rng.integers(1, 1 << 62, 2)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row."""
    h, first = W.word_hashes(data, offsets)
    s = W.runs(h, size)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= size:
            u = np.sort(s[a:b - size + 1])
            out.append(u[np.concatenate([[True], u[1:] != u[:-1]])])
        else:
            out.append(np.array([W.one_run(h[a:b])], np.uint64) if b > a else np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Densified bin values, one row per non-empty set."""
    values = np.zeros((len(sets), BINS), np.uint64)
    filled = np.zeros((len(sets), BINS), bool)
    for k, u in enumerate(sets):
        edges = np.searchsorted(u, _EDGES)
        low = np.concatenate([[0], edges])
        filled[k] = np.concatenate([edges, [len(u)]]) > low
        values[k] = u[np.minimum(low, len(u) - 1)]
    for k in np.flatnonzero(~filled.all(axis=1)):
        empty = np.flatnonzero(~filled[k])
        order = _ORDER[empty]
        values[k, empty] = values[k, order[np.arange(len(empty)), filled[k][order].argmax(axis=1)]]
    return values


def _sets_frame(docs: DataFrame, size: int, rows: int) -> DataFrame:
    """(doc_id, text_hash, id, n, h1, h2, bands, sig) of every row."""
    bands = BINS // rows

    def read(batches):
        for batch in batches:
            for i, j, data, offsets in W.pieces(batch.column(2)):
                sets = shingle_sets(data, offsets, size)
                n = np.array([len(u) for u in sets], np.int64)
                has = np.flatnonzero(n)
                values = signatures([sets[k] for k in has])
                keys = np.zeros((len(has), bands), np.uint64)
                for r in range(rows):
                    keys = W.mix(keys * W.U(0x9E3779B97F4A7C15) + values[:, r:bands * rows:rows])
                keys = W.mix(keys + np.arange(1, bands + 1, dtype=np.uint64) * W.U(0xD6E8FEB86659FD93))
                h = np.zeros((2, len(sets)), np.uint64)
                for k in has:
                    for c in (0, 1):
                        h[c, k] = W.mix(sets[k] * _SET[c]).sum(dtype=np.uint64)
                lists = np.zeros(len(sets) + 1, np.int32)
                lists[1:] = np.cumsum(np.where(n > 0, bands, 0))
                low = values.astype("<u2")
                sig = [None] * len(sets)
                for at, k in enumerate(has):
                    sig[k] = low[at].tobytes()
                ids = batch.column(0).slice(i, j - i)
                stand_in = pa.array((h[0] >> W.U(2)).view(np.int64) + STAND_IN, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    ids, batch.column(1).slice(i, j - i), pa.compute.coalesce(ids.cast(pa.int64()), stand_in), pa.array(n),
                    pa.array(h[0].view(np.int64)), pa.array(h[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(lists), pa.array(keys.ravel().view(np.int64))), pa.array(sig, pa.binary())],
                    names=["doc_id", "text_hash", "id", "n", "h1", "h2", "bands", "sig"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        read, f"doc_id {kind}, text_hash long, id long, n long, h1 long, h2 long, bands array<long>, sig binary")


def _node_sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(id, set) of the rows whose id is in ``nodes``; only ids that pass a bit filter of fixed size are read."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(nodes, "id", NODE_BITS))

    def read(batches):
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            known = ids.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
            take = pa.array(np.flatnonzero(in_filter(shared.value, known) | ids.is_null().to_numpy(zero_copy_only=False)))
            ids, texts = ids.take(take), batch.column(1).take(take)
            for i, j, data, offsets in W.pieces(texts):
                sets = shingle_sets(data, offsets, size)
                stand_in = [int((W.mix(u * _SET[0]).sum(dtype=np.uint64) >> W.U(2)).view(np.int64)) + STAND_IN for u in sets]
                yield pa.RecordBatch.from_arrays([
                    pa.compute.coalesce(ids.slice(i, j - i), pa.array(stand_in, pa.int64())),
                    pa.array([u.astype("<u8").tobytes() for u in sets], pa.binary())], names=["id", "set"])

    return docs.select("doc_id", "text").mapInArrow(read, "id long, set binary").join(nodes, "id", "left_semi")


def _confirmed(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links."""
    share = percent / 100

    def may_link(batches):
        for batch in batches:
            col = {name: batch.column(name) for name in ("na", "nb")}
            small = np.minimum(*(c.to_numpy() for c in col.values()))
            a, b = (np.frombuffer(b"".join(batch.column(name).to_pylist()), "<u2").reshape(-1, BINS) for name in ("siga", "sigb"))
            error = np.sqrt(share * (1 - share) / np.maximum(np.minimum(small, BINS) / 2, 1))  # filled bins repeat values: half count
            keep = (a == b).mean(axis=1) >= share - 5 * error
            yield pa.RecordBatch.from_arrays([batch.column(name).filter(pa.array(keep)) for name in ("a", "b")], names=["a", "b"])

    def link(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("seta"), batch.column("setb"), strict=True):
                u, v = np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")
                both = len(np.intersect1d(u, v, assume_unique=True))
                keep.append(100 * both >= percent * (len(u) + len(v) - both))
            yield pa.RecordBatch.from_arrays([batch.column(name).filter(pa.array(keep, pa.bool_())) for name in ("a", "b")], names=["a", "b"])

    side = lambda s: nodes.select(F.col("id").alias(s), F.col("n").alias(f"n{s}"), F.col("sig").alias(f"sig{s}"))
    sized = (pairs.join(side("a"), "a").join(side("b"), "b")
             .where((F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)))
    likely = sized.mapInArrow(may_link, "a long, b long").distinct()
    full = likely.join(sets.select(F.col("id").alias("b"), F.col("set").alias("setb")), "b").join(
        sets.select(F.col("id").alias("a"), F.col("set").alias("seta")), "a")
    return full.select("a", "b", "seta", "setb").mapInArrow(link, "a long, b long").distinct()


def _prefix_pairs(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ``rest`` (id, comp) that differ in ``comp`` and whose shared prefix shingle allows a link.

    Shingles are ordered by rarity.  Of two sets that are a link, the larger one's first n - ceil(t n) + 1 and the
    smaller one's first n - ceil(2 t n / (1 + t)) + 1 shingles have one in common, at places that leave room for the
    overlap needed.  A shingle's rows are dealt over blocks, so that no task gets all of a common one.
    """
    own = stored(sets.join(rest, "id").dropDuplicates(["id", "set"]), "dedup-rest-sets")
    mask = W.U(COUNTERS - 1)

    def slots(batches):
        for batch in batches:
            slot, n = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u8") & mask, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(n.astype(np.int64))], names=["slot", "n"])

    got = own.select("set").mapInArrow(slots, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most COUNTERS rows
    counts = np.zeros(COUNTERS, np.int64)
    counts[got.column("slot").to_numpy()] = got.column("n").to_numpy()
    shared = rest.sparkSession.sparkContext.broadcast(counts)

    def prefixes(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                ids = part.column("id").to_numpy()
                out = []
                for k, x in enumerate(part.column("set").to_pylist()):
                    u = np.frombuffer(x, "<u8")
                    n, c = len(u), shared.value[u & mask]
                    first = np.lexsort((u, c))[:n + (-percent * n) // 100 + 1]
                    pos = np.flatnonzero(c[first] > 1)
                    blocks = -(-c[first[pos]] // BLOCK)
                    out.append((u[first[pos]].view(np.int64), np.full(len(pos), k), np.full(len(pos), n), pos,
                                pos <= n + (-2 * percent * n) // (100 + percent), blocks))
                shingle, row, n, pos, short, blocks = (np.concatenate(x) for x in zip(*out, strict=True))
                block = (W.mix(ids[row].view(np.uint64)) % blocks.astype(np.uint64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(shingle), pa.array(ids[row]), part.column("comp").take(pa.array(row)),
                                                  *(pa.array(x) for x in (n, pos, short, blocks, block))],
                                                 names=["shingle", "id", "comp", "n", "pos", "short", "blocks", "block"])

    kept = stored(own.select("id", "comp", "set").mapInArrow(
        prefixes, "shingle long, id long, comp long, n long, pos long, short boolean, blocks long, block long"), "dedup-prefixes")
    several = kept.groupBy("shingle").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select(F.col("shingle").alias("of"))
    kept = stored(kept.join(several, F.col("shingle") == F.col("of"), "left_semi"), "dedup-shared-prefixes")  # one component's shingles join nothing

    def side(rows, s, here, other):
        named = [F.col(x).alias(x + s) for x in ("id", "comp", "n", "pos")]
        return rows.select("shingle", *named, F.col("block").alias(here), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias(other))

    room = F.expr(f"least(nx - posx, ny - posy) * {100 + percent} >= {percent} * (nx + ny)")
    both = side(kept.where("short"), "x", "bx", "by").join(side(kept, "y", "by", "bx"), ["shingle", "bx", "by"])
    both = both.where(F.expr(f"compx <> compy and (nx < ny or nx = ny and idx < idy) and nx * 100 >= ny * {percent}") & room)
    return both.select(F.least("idx", "idy").alias("a"), F.greatest("idx", "idy").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) of every node of ``edges`` (a, b): the smallest id of its component, by alternating star contractions.

    Each step points nodes at the smallest neighbour; the number of steps grows with the
    logarithm of the longest chain.  The neighbours of a node are never gathered.
    """
    def mark(d):
        return d.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()

    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    was = mark(now)
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        after = stored(small.where("a <> b").distinct(), "links")
        if (mark_after := mark(after)) == was:
            return after.select(F.col("a").alias("id"), F.col("b").alias("comp")).union(after.select(F.col("b").alias("id"), "b").distinct())
        now, was = after, mark_after


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = MIN_PERCENT, rows: int = ROWS) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, component_id, kept."""
    base = stored(_sets_frame(docs, size, rows), "dedup-sets")
    classes = (base.where("n > 0").groupBy("n", "h1", "h2").agg(F.min(F.struct("id", "bands", "sig")).alias("r"))
               .select("n", "h1", "h2", F.col("r.id").alias("id"), F.col("r.bands").alias("bands"), F.col("r.sig").alias("sig")))
    classes = stored(classes, "dedup-classes")
    keyed = classes.select("id", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("size"))
    found = stored(keyed.join(shared.where("low < high").select("key", "size"), "key"), "dedup-buckets")
    degree = stored(found.groupBy("id").agg(F.sum("size").alias("degree")), "dedup-nodes")
    nodes = degree.select("id")
    sets = stored(_node_sets(docs, nodes, size), "dedup-node-sets")
    known = stored(classes.select("id", "n", "sig").join(nodes, "id", "left_semi"), "dedup-signatures")

    members = found.select("key", "id").join(degree, "id")
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("degree"), "id"))
    first = members.withColumn("nth", nth).where("nth = 1").select("key", F.col("id").alias("hub"))
    members = stored(members.join(first, "key").where("id <> hub"), "dedup-members")
    pairs = members.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    edges = stored(_confirmed(pairs, known, sets, percent), "dedup-links")
    labelled = members.select("key", "id").join(components(edges), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    mixed = labelled.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("key")
    rest = stored(labelled.join(mixed, "key", "left_semi").select("id", "comp").distinct(), "dedup-rest")
    pairs = _prefix_pairs(rest, sets, percent)
    comp = components(stored(edges.union(_confirmed(pairs, known, sets, percent)).distinct(), "dedup-links"))

    class_comp = classes.select("n", "h1", "h2", F.col("id").alias("rep")).join(comp.select(F.col("id").alias("rep"), "comp"), "rep", "left").select(
        "n", "h1", "h2", F.coalesce("comp", "rep").alias("comp"))
    found = base.select("doc_id", "text_hash", "id", "n", "h1", "h2").join(class_comp, ["n", "h1", "h2"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.when(F.col("comp") < STAND_IN, F.col("comp")))
    out = found.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), component.cast("long").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_per_group(docs: DataFrame, size: int = 5, percent: int = 80, rows: int = 4) -> DataFrame:
    """The row of ``docs`` with the smallest id of every group of near-duplicates, once."""
    kept = stored(near_duplicates(docs, size, percent, rows).where("kept").groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
                  .agg(F.count(F.lit(1)).alias("_n")), "dedup-kept")
    source = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"))

    def rows_of(keys):
        same = source["_id"].eqNullSafe(keys["_id"]) & (source["_hash"] == keys["_hash"])
        return source.join(keys.hint("shuffle_hash"), same, "left_semi")

    out = rows_of(kept.where("_n = 1")).select("_row.*")
    again = kept.where("_n > 1")
    if again.isEmpty():
        return out
    return out.unionByName(rows_of(again).dropDuplicates(["_id", "_hash"]).select("_row.*"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")
