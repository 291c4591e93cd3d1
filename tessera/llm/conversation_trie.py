"""Prefix trie of conversations by the Euler-tour technique.

Every conversation is rebuilt: it opens with turns of the first conversation of its block of
``FAMILY`` ids, as many as a hash of its id says, and goes on with its own later turns.  A
distinct sequence of first d turns is a node.  A node is known by its smallest member and its depth,
since a conversation has one prefix of a length.

1. **Turns.** Rows are range-sorted by conversation and turn, which gives places without a window
   over a conversation.  A prefix is known by the XOR of hashes of (place, role, text), 128 bits, so
   prefixes are running XORs: inside blocks of ``BLOCK`` places, plus the XOR of the blocks before.
2. **Nodes.** One aggregate by prefix; parents by one join; next siblings by a range sort.
3. **Tour.** Each node has an enter and an exit arc, each arc one successor.  Nodes with one
   smallest member lie on one path, and arcs that follow each other on it form runs (cut every ``BLOCK`` depths).
4. **List ranking.** Runs double their pointers until all see the end of the tour: at most
   log2(runs) rounds, each a join with distinct keys, each written before the next.
5. **Prefix sums** of leaves and savings over the arcs' positions, in ``RANGES`` ranges of
   positions; a subtree's sum is the difference between its exit and its enter arc.
6. **Ends.** Members that end at a node are range-sorted, joined to strings of at most
   ``CHUNK_IDS`` ids, and the strings of a node are streamed in order through SHA-256.  So the task that must
   read a node's whole list (a digest has no parts) reads few rows and holds one of them.

Defined cases: null role and text are ''; turns are ordered null first, turns of equal number by role, then
text; rows without conv_id belong to no conversation and are left out; a conversation may come out
without turns and is a member of the root alone; equal rows are separate turns; an empty table gives no
rows; other columns are ignored.  Negative ids belong to the block whose first id is nearer to 0.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.sources.tables import table

FAMILY, SHARED = 5, 9
BLOCK = 512  # places or depths that one window holds
RANGES = 4096  # ranges of tour positions
CHUNK_IDS = 512
NODE = ["d", "z1", "z2"]


def _placed(conversations: DataFrame) -> DataFrame:
    """(c, pos, t1, t2, bytes): every turn with its place in its conversation, from 1, and the hashes of role and text."""
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("turn"), *[F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("role", "text")])
    order = [F.col("c"), F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    parts = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "c", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), F.xxhash64("role", "text").alias("t1"),
        F.xxhash64(F.lit("second"), "text", "role").alias("t2"), F.octet_length("text").cast("long").alias("bytes")), "trie-turns")
    sizes = parts.groupBy("c", "part").agg(F.count(F.lit(1)).alias("n"))  # a conversation has one row for a range it touches
    before = F.sum("n").over(Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("c", "part", F.coalesce(before, F.lit(0)).alias("off"))
    own = F.row_number().over(Window.partitionBy("c", "part").orderBy("at"))
    return parts.withColumn("own", own).join(offsets, ["c", "part"]).select("c", (F.col("off") + F.col("own")).alias("pos"), "t1", "t2", "bytes")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, length) of every rebuilt conversation, and its turns (c, d, t1, t2, bytes, last)."""
    turns = stored(_placed(conversations), "trie-places")
    h = lambda c: F.crc32(F.col(c).cast("string")) % SHARED
    sizes = turns.groupBy("c").agg(F.max("pos").alias("own"))
    convs = sizes.select("c", "own", (F.col("c") - F.col("c") % FAMILY).alias("first"), h("c").alias("h"))
    firsts = sizes.select(F.col("c").alias("first"), F.col("own").alias("first_own"))
    convs = convs.join(firsts, "first", "left").withColumn("taken", F.least("h", F.coalesce("first_own", F.lit(0))))
    convs = stored(convs.select("c", "first", "taken", "h", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "trie-conversations")
    opening = turns.where((F.col("c") % FAMILY == 0) & (F.col("pos") < SHARED)).withColumnRenamed("c", "first")
    opening = opening.join(convs, "first").where("pos <= taken").select("c", F.col("pos").alias("d"), "t1", "t2", "bytes", "length")
    later = turns.where(F.col("pos") > h("c")).join(convs, "c").select("c", (F.col("taken") + F.col("pos") - F.col("h")).alias("d"), "t1", "t2", "bytes", "length")
    return convs.select("c", "length"), opening.union(later).select("c", "d", "t1", "t2", "bytes", (F.col("d") == F.col("length")).alias("last"))


def _prefixes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(c, d, z1, z2, p1, p2, bytes, last): the prefix that ends with each turn, the one before, and the empty prefix."""
    mixed = turns.select("c", "d", "bytes", "last", F.xxhash64("d", "t1", "t2").alias("x1"), F.xxhash64("t2", "d", "t1").alias("x2"),
                         F.floor((F.col("d") - 1) / BLOCK).alias("block"))
    blocks = mixed.groupBy("c", "block").agg(*[F.expr(f"bit_xor(x{k})").alias(f"b{k}") for k in (1, 2)])
    before = "over (partition by c order by block rows between unbounded preceding and 1 preceding)"
    carried = blocks.select("c", "block", *[F.expr(f"bit_xor(b{k}) {before}").alias(f"o{k}") for k in (1, 2)]).where("block > 0")
    inside = mixed.select("*", *[F.expr(f"bit_xor(x{k}) over (partition by c, block order by d)").alias(f"w{k}") for k in (1, 2)])
    z = [F.col(f"w{k}").bitwiseXOR(F.coalesce(F.col(f"o{k}"), F.lit(0).cast("long"))) for k in (1, 2)]
    some = inside.join(carried, ["c", "block"], "left").select(
        "c", F.col("d").cast("long").alias("d"), z[0].alias("z1"), z[1].alias("z2"), z[0].bitwiseXOR(F.col("x1")).alias("p1"), z[1].bitwiseXOR(F.col("x2")).alias("p2"), "bytes", "last")
    none = F.lit(0).cast("long")
    empty = convs.select("c", *[none.alias(x) for x in NODE], *[F.lit(None).cast("long").alias(x) for x in ("p1", "p2")], none.alias("bytes"), (F.col("length") == 0).alias("last"))
    return stored(some.union(empty), "trie-prefixes")


def _ends(prefixes: DataFrame) -> DataFrame:
    """(d, z1, z2, sha) of the nodes at which conversations end."""
    def join_ids(batches):
        for batch in batches:
            key = [batch.column(k).to_numpy() for k in range(3)]
            ids = pc.cast(batch.column(3), pa.string()).to_pylist()
            new = np.ones(len(ids), bool)
            new[1:] = np.any([x[1:] != x[:-1] for x in key], axis=0)
            start = np.flatnonzero(new)
            cuts = np.unique(np.concatenate([np.arange(a, b, CHUNK_IDS) for a, b in zip(start, [*start[1:], len(ids)], strict=True)]))
            texts = [",".join(ids[a:b]) for a, b in zip(cuts, [*cuts[1:], len(ids)], strict=True)]
            at = pa.array(cuts)
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(4)), pa.array(texts, pa.string())], names=[*NODE, "low", "ids"])

    def digest(batches):
        now, sha = None, None
        for batch in batches:
            out = []
            for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    if now:
                        out.append((*now, sha.hexdigest()))
                    now, sha = key, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip([*NODE, "sha"], x, strict=True)) for x in out], schema=schema)
        if now:
            yield pa.RecordBatch.from_pylist([dict(zip([*NODE, "sha"], (*now, sha.hexdigest()), strict=True))], schema=schema)

    schema = pa.schema([*[(x, pa.int64()) for x in NODE], ("sha", pa.string())])
    rows = prefixes.where("last").select(*NODE, "c")
    chunks = rows.repartitionByRange(*NODE, "c").sortWithinPartitions(*NODE, "c").mapInArrow(join_ids, "d long, z1 long, z2 long, low long, ids string")
    return chunks.repartition(*NODE).sortWithinPartitions(*NODE, "low").mapInArrow(digest, "d long, z1 long, z2 long, sha string")


def _nodes(prefixes: DataFrame) -> DataFrame:
    """(d, z1, z2, m, n, bytes, pm): smallest member, members, bytes of the last text, the parent's smallest member."""
    own = stored(prefixes.groupBy(*NODE).agg(F.min("c").alias("m"), F.count(F.lit(1)).alias("n"), F.max("bytes").alias("bytes"),
                                             F.max("p1").alias("p1"), F.max("p2").alias("p2")), "trie-nodes")
    above = own.select((F.col("d") + 1).alias("d"), F.col("z1").alias("p1"), F.col("z2").alias("p2"), F.col("m").alias("pm"))
    below = own.where("d > 0").join(above, ["d", "p1", "p2"]).select(*NODE, "m", "n", "bytes", "pm")
    top = own.where("d = 0").select(*NODE, "m", "n", "bytes", F.lit(None).cast("long").alias("pm"))
    return stored(below.union(top), "trie-parents")


def _siblings(nodes: DataFrame) -> DataFrame:
    """(m, d, sibling): the next child of the same parent, by smallest member.  A parent's children may lie in many ranges."""
    order = ["pm", "d", "m"]
    parts = stored(nodes.where("d > 0").select(*order).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "trie-children")
    lows = parts.groupBy("pm", "d", "part").agg(F.min("m").alias("low"))
    lows = lows.select("pm", "d", "part", F.lead("low").over(Window.partitionBy("pm", "d").orderBy("part")).alias("beyond"))
    near = F.lead("m").over(Window.partitionBy("pm", "d", "part").orderBy("m"))
    return parts.withColumn("near", near).join(lows, ["pm", "d", "part"]).select("m", "d", F.coalesce("near", "beyond").alias("sibling"))


def _arcs(nodes: DataFrame, children: DataFrame) -> DataFrame:
    """(m, k, run, off, leaf, saved, sm, sk): arcs with their successor and their place in a run.

    Arc 2 d enters node (m, d), arc 2 d + 1 leaves it.  ``run`` is the number of the run's first arc.
    """
    full = (nodes.select("m", "d", "pm", "n", "bytes").join(children, ["m", "d"], "left").join(_siblings(nodes), ["m", "d"], "left")
            .na.fill(0, ["n_children", "others"]))
    saved = (F.col("n") - 1) * F.col("bytes")
    down = F.struct(F.lit(0).alias("kind"), F.col("d").alias("by"), (F.col("n_children") == 0).cast("long").alias("leaf"), saved.alias("saved"),
                    F.coalesce("child", "m").alias("sm"), F.when(F.col("child").isNull(), 2 * F.col("d") + 1).otherwise(2 * F.col("d") + 2).alias("sk"),
                    (F.coalesce(F.col("pm") != F.col("m"), F.lit(True)) | (F.col("d") % BLOCK == 0)).alias("head"))
    zero = F.lit(0).cast("long")
    up = F.struct(F.lit(1).alias("kind"), (-F.col("d")).alias("by"), zero.alias("leaf"), zero.alias("saved"),
                  F.coalesce("sibling", "pm").alias("sm"), F.when(F.col("sibling").isNull(), 2 * F.col("d") - 1).otherwise(2 * F.col("d")).alias("sk"),
                  ((F.col("others") > 0) | ((F.col("d") + 1) % BLOCK == 0)).alias("head"))
    arcs = full.select("m", "d", F.floor(F.col("d") / BLOCK).alias("block"), F.explode(F.array(down, up)).alias("a")).select(
        "m", (2 * F.col("d") + F.col("a.kind")).alias("k"), "block", "a.*")
    path = Window.partitionBy("m", "block").orderBy("kind", "by")
    nth = F.row_number().over(path)
    arcs = arcs.withColumn("nth", nth).withColumn("top", F.max(F.when(F.col("head"), F.struct("nth", "k"))).over(path))
    return stored(arcs.select("m", "k", F.col("top.k").alias("run"), (F.col("nth") - F.col("top.nth")).cast("long").alias("off"), "leaf", "saved", "sm", "sk"), "trie-arcs")


def list_rank(links: DataFrame) -> DataFrame:
    """(m, k, dist): the weight from each element (m, k) to the end of its list, by pointer doubling.

    ``links`` has (m, k, sm, sk, dist): the successor (null at the end) and the weight up to it.
    """
    now = stored(links, "trie-rank")
    while not (ahead := now.where("sm is not null")).isEmpty():
        to = now.select(F.col("m").alias("sm"), F.col("k").alias("sk"), F.col("sm").alias("tm"), F.col("sk").alias("tk"), F.col("dist").alias("more"))
        moved = ahead.join(to, ["sm", "sk"]).select("m", "k", F.col("tm").alias("sm"), F.col("tk").alias("sk"), (F.col("dist") + F.col("more")).alias("dist"))
        now = stored(now.where("sm is null").select(*moved.columns).union(moved), "trie-rank")
    return now.select("m", "k", "dist")


def _subtrees(arcs: DataFrame) -> DataFrame:
    """(m, d, n_leaves, saved_tokens, enter_at, exit_at) of every node."""
    runs = arcs.groupBy("m", "run").agg(F.max_by(F.struct("sm", "sk"), "off").alias("s"), F.count(F.lit(1)).alias("dist"))
    ranked = list_rank(runs.select("m", F.col("run").alias("k"), "s.sm", "s.sk", "dist"))
    total = arcs.count()
    place = (F.lit(total) - F.col("dist") + F.col("off")).alias("at")
    # no overflow: a range number is a quotient of doubles, exact enough to order positions
    spread = F.least(F.floor(F.col("at") / F.lit(max(total, 1)) * RANGES), F.lit(RANGES - 1)).alias("range")
    placed = stored(arcs.join(ranked.withColumnRenamed("k", "run"), ["m", "run"]).select("m", "k", "leaf", "saved", place).select("*", spread), "trie-tour")
    sums = placed.groupBy("range").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    before = Window.partitionBy().orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # at most RANGES rows
    carried = sums.select("range", *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}_before") for x in ("leaf", "saved")])
    upto = Window.partitionBy("range").orderBy("at")
    run = placed.select("*", *[F.sum(x).over(upto).alias(f"{x}_upto") for x in ("leaf", "saved")]).join(F.broadcast(carried), "range")
    leaving = F.col("k") % 2 == 1
    side = lambda x: F.sum(F.when(leaving, 1).otherwise(-1) * (F.col(f"{x}_before") + F.col(f"{x}_upto")) + F.col(x))
    return run.groupBy("m", F.floor(F.col("k") / 2).alias("d")).agg(
        side("leaf").alias("n_leaves"), side("saved").alias("saved_tokens"), F.max(F.when(~leaving, F.col("at"))).alias("enter_at"), F.max(F.when(leaving, F.col("at"))).alias("exit_at"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, enter_at, exit_at."""
    prefixes = _prefixes(*rebuilt(conversations))
    nodes = _nodes(prefixes)
    children = nodes.where("d > 0").groupBy(F.col("pm").alias("m"), (F.col("d") - 1).alias("d")).agg(
        F.count(F.lit(1)).alias("n_children"), F.min("m").alias("child"), F.count(F.when(F.col("m") != F.col("pm"), 1)).alias("others"))
    children = stored(children, "trie-children-counts")
    out = nodes.join(children, ["m", "d"], "left").join(_subtrees(_arcs(nodes, children)), ["m", "d"]).join(_ends(prefixes), NODE, "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("m").alias("conv_id"), F.col("d").alias("depth"), F.col("pm").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                      F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
                      F.coalesce("sha", F.lit(nothing)).alias("ends_sha256"), "enter_at", "exit_at")


def trie_sql() -> str:
    """The same nodes from DuckDB: prefixes as lists, subtrees by comparing lists; CRC-32 bit by bit."""
    crc = ("xor(list_reduce([CAST(4294967295 AS BIGINT)] || flatten(list_transform(range(1, length(s) + 1), lambda i: "
           "[CAST(ascii(substr(s, i, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])), "
           "lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295)")
    return f"""
WITH RECURSIVE x AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS pos FROM x),
i AS (SELECT c, count(*) AS own, c - c % {FAMILY} AS first, CAST(c AS VARCHAR) AS s FROM t GROUP BY c),
v AS (SELECT c, own, first, {crc} % {SHARED} AS h FROM i),
r AS (SELECT v.c, t.pos AS d, role, text FROM v JOIN t ON t.c = v.first WHERE pos <= h
      UNION ALL SELECT v.c, least(v.h, coalesce(b.own, 0)) + t.pos - v.h, role, text FROM v JOIN t ON t.c = v.c LEFT JOIN v b ON b.c = v.first WHERE pos > v.h),
q AS (SELECT v.c, coalesce(list(struct_pack(role := r.role, text := r.text) ORDER BY d) FILTER (d IS NOT NULL), []) AS turns FROM v LEFT JOIN r ON r.c = v.c GROUP BY v.c),
p AS (SELECT c, d, turns[1:d] AS pre, len(turns) AS length FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM q)),
n AS (SELECT d, pre, min(c) AS m, count(*) AS n, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (length = d), '')) AS sha,
             CASE WHEN d = 0 THEN 0 ELSE strlen(pre[d].text) END AS bytes FROM p GROUP BY d, pre),
f AS (SELECT a.d, a.pre, count(b.d) AS n_children FROM n a LEFT JOIN n b ON b.d = a.d + 1 AND b.pre[1:a.d] = a.pre GROUP BY a.d, a.pre),
e AS (SELECT n.*, f.n_children FROM n JOIN f ON f.d = n.d AND f.pre = n.pre),
g AS (SELECT a.d, a.pre, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n - 1) * b.bytes) AS saved, count(*) AS size FROM e a JOIN e b ON b.d >= a.d AND b.pre[1:a.d] = a.pre GROUP BY a.d, a.pre),
k AS (SELECT e.*, g.n_leaves, g.saved, g.size, u.m AS pm FROM e JOIN g ON g.d = e.d AND g.pre = e.pre LEFT JOIN e u ON u.d = e.d - 1 AND u.pre = e.pre[1:u.d]),
o AS (SELECT *, 2 * coalesce(sum(size) OVER (PARTITION BY d, pm ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS shift FROM k),
w AS (SELECT d, pm, m, 0 :: HUGEINT AS at FROM o WHERE d = 0 UNION ALL SELECT o.d, o.pm, o.m, w.at + o.shift FROM o JOIN w ON o.d = w.d + 1 AND o.pm = w.m)
SELECT o.m AS conv_id, o.d AS depth, o.pm AS parent_conv_id, o.n AS n_convs, o.n_children, o.n_leaves, CAST(o.saved AS BIGINT) AS saved_tokens, o.sha AS ends_sha256,
       CAST(w.at AS BIGINT) AS enter_at, CAST(w.at + 2 * o.size - 1 AS BIGINT) AS exit_at
FROM o JOIN w ON w.d = o.d AND w.m = o.m
"""


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))
