"""The conversation trie against plain Python and SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tessera.llm import conversation_trie as T
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck_connect

ROWS = "conv_id long, turn long, role string, text string, d long, m long, k long, z1 long"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], ROWS)


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(own)] for c, own in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (c % 5 if c >= 0 else -(-c % 5))
        whole[c] = tuple(turns.get(first, [])[:h] + own[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, own in whole.items():
        for d in range(len(own) + 1):
            members[own[:d]].append(c)
            if d:
                children[own[:d - 1]].add(own[:d])
    below = {}
    for node in sorted(members, key=len, reverse=True):
        save = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        below[node] = (sum(below[x][0] for x in children[node]) or 1, save + sum(below[x][1] for x in children[node]))
    out = set()
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in own if len(whole[c]) == len(node)))
        out.add((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children[node]), *below[node],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rows_of(frame):
    rows = [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_rows(seed, convs, words, most):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for turn in range(rng.randint(1, most)):
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["user", "user", None, ""]), rng.choice([*words, None])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limits", [{}, {"BLOCK": 2, "RANGES": 5, "CHUNK_IDS": 2}])
def test_matches_plain_python(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(T, name, value)
    rows = random_rows(1, [*range(-7, 40), 100, 103, 2**40 + 1], ["a", "b", "été"], 7)
    rows += [(None, 1, "user", "no conversation"), (3, 1, "user", "a"), (3, 1, "user", "a")]
    assert rows_of(T.conversation_trie(table(spark, rows))) == brute(rows)


def test_tour_positions_nest(spark):
    rows = random_rows(2, range(30), ["a", "b"], 6)
    got = T.conversation_trie(table(spark, rows)).collect()
    assert sorted(x for r in got for x in (r.enter_at, r.exit_at)) == list(range(2 * len(got)))
    at = {(r.conv_id, r.depth): (r.enter_at, r.exit_at) for r in got}
    for r in got:
        if r.depth:
            low, high = at[r.parent_conv_id, r.depth - 1]
            assert low < r.enter_at < r.exit_at < high


def test_copies_a_hot_first_turn_and_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 64)
    monkeypatch.setattr(T, "CHUNK_IDS", 16)
    rows = [(c, t, "user", x) for c in range(0, 1500, 5) for t, x in enumerate(("hello", "same"))]  # 300 copies
    rows += [(c, t, "user", x) for c in range(1500, 2500, 5) for t, x in enumerate(("hello", f"other {c}"))]
    rows += [(5000, t, "user", f"turn {t % 7}") for t in range(700)]
    rows += [(5005, 0, "user", "x" * (1 << 20)), (5010, 0, "user", "x" * (1 << 20))]
    assert rows_of(T.conversation_trie(table(spark, rows))) == brute(rows)


def test_conversations_without_turns(spark):
    rows = [(c, 0, "user", "only") for c in range(11, 60) if c % 5]  # no first conversation: short ones come out empty
    got = rows_of(T.conversation_trie(table(spark, rows)))
    assert got == brute(rows)
    assert any(d == 0 and ends != hashlib.sha256(b"").hexdigest() for _, d, *_, ends in got)


def test_list_rank_of_a_long_list_and_two_ends(spark):
    n = 300
    links = [(i, 0, i + 1 if i + 1 < n else None, 0 if i + 1 < n else None, i + 1) for i in range(n)] + [(9999, 1, None, None, 5)]
    got = {(r.m, r.k): r.dist for r in T.list_rank(spark.createDataFrame(links, "m long, k long, sm long, sk long, dist long")).collect()}
    assert got == {**{(i, 0): sum(range(i + 1, n + 1)) for i in range(n)}, (9999, 1): 5}


def test_empty_table(spark):
    assert T.conversation_trie(table(spark, [])).collect() == []


def test_sql(spark):
    got = compare(T.op13_conversation_trie(spark, SF_SMALL), duck_connect(SF_SMALL).sql(T.trie_sql()))
    assert got["values_match"], got
