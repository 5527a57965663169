"""The conversation trie against a plain one, built turn by turn in a dictionary."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings as hyp
from hypothesis import strategies as st

from tidemark.llm import convtrie
from tidemark.llm.queries import QUERIES

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """``rows`` of (conv_id, turn, role, text); equal turn numbers don't occur in one conversation."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(own.items()):
        h = zlib.crc32(str(c).encode()) % 6
        path = own.get(c - c % 100, [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = sum(saved[x] for x in children[node]) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(((m[0], len(node), members[node[:-1]][0] if node else None, len(m), len(children[node]), leaves[node], saved[node], sha(ends.get(node, [])))
                   for node, m in members.items()), key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


SCHEMA = "conv_id long, turn long, role string, text string, n long, place string, c1 int, blk string, turns int, n_convs int, least string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", 2, "b", 3, 4, "l") for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_the_plain_trie(spark, sf, size):
    sf = sf.replace("sf0.001", size)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = QUERIES["op12_conversation_trie"](spark, sf)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [*((c, "bigint") for c in COLUMNS[:-1]), ("ends_sha256", "string")]
    assert got(df) == plain(rows)


EDGES = [
    (1, 0, "user", None), (1, 1, None, "hé\U0001F511"), (2, None, "user", "x"), (2, -5, "user", "y"), (2, -(1 << 62), "user", "z"), (None, 0, "user", "no id"),
    (100, 3, "user", "base"), (101, 0, "user", "own"), (150, 7, "a", "b"), (150, 8, "", "ab"), (151, 7, "ab", ""), (151, 8, "", "ab"), (0, 0, "user", "long " * 40_000),
]


def test_edges(spark):
    assert got(convtrie.prefix_trie(frame(spark, EDGES))) == plain(EDGES)


def test_empty_table(spark):
    df = convtrie.prefix_trie(frame(spark, []))
    assert df.count() == 0 and df.columns == COLUMNS


def test_repeated_rows_are_turns_in_a_defined_order(spark):
    rows = [(7, 0, "user", "a"), (7, 0, "user", "a"), (7, 0, "user", "b"), (7, 0, "assistant", "c")]
    once = got(convtrie.prefix_trie(frame(spark, rows)))
    assert once == got(convtrie.prefix_trie(frame(spark, rows[::-1]).coalesce(1))) and max(r[1] for r in once) <= 4


def copies(rnd, n, length, kinds):
    """Conversations that share beginnings of every length, among them exact copies."""
    rows, base = [], [("user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(length)]
    for c in range(n):
        cut = rnd.choice([length, length, rnd.randrange(length + 1)])
        path = base[:cut] + [("user", f"t{rnd.randrange(kinds)}") for _ in range(rnd.randrange(4))]
        rows += [(c, t, *x) for t, x in enumerate(path)]
    return rows


@pytest.mark.parametrize("settings", [convtrie.Settings(), convtrie.Settings(block=1, salts=1), convtrie.Settings(block=3, stretch=4, salts=2)])
def test_long_shared_beginnings(spark, settings):
    rows = copies(random.Random(4), 90, 37, 3)
    assert got(convtrie.prefix_trie(frame(spark, rows), settings)) == plain(rows)


def test_one_conversation_of_many_turns_is_cut(spark, monkeypatch):
    from tidemark.operators import prefix

    monkeypatch.setattr(prefix, "BLOCK_ROWS", 16)
    rows = [(c, t, "user", f"{t % 3}") for c, n in ((3, 300), (4, 300), (205, 7), (200, 2)) for t in range(n)]
    assert got(convtrie.prefix_trie(frame(spark, rows), convtrie.Settings(block=2, stretch=50))) == plain(rows)


turns_st = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", "yy", None])), max_size=7)


@hyp(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(convs=st.dictionaries(st.sampled_from([0, 1, 2, 3, 100, 104, 199, 200, 201, 5000]), turns_st, max_size=8), block=st.integers(1, 4))
def test_any_conversations(spark, convs, block):
    rows = [(c, t, *x) for c, turns in convs.items() for t, x in enumerate(turns)]
    assert got(convtrie.prefix_trie(frame(spark, rows), convtrie.Settings(block=block))) == plain(rows)
