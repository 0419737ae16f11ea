from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tidegauge.llm import prefixes
from tidegauge.llm.queries import QUERIES

TABLE = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(rows):
    """Every prefix of every rebuilt conversation, listed and counted."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(turns, key=lambda t: t[0])] for c, turns in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 6
        turns = own.get(base, [])[:h] + turns[h:]
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def sums(node):
        leaves, spared = 0, (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        below = [node]
        while below:
            kids = children.get(below.pop(), [])
            below += kids
            spared += sum((len(members[k]) - 1) * len(k[-1][1]) for k in kids)
            leaves += sum(k not in children for k in kids)
        return leaves or 1, spared

    return sorted((
        min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])), *sums(node),
        hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
    ) for node, m in members.items())


def listed(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def odd_rows():
    pick = random.Random(5)
    rows = [(c, t, pick.choice(["user", "assistant", None]), pick.choice(["a", "b", "é", "", None, "𝄞x"]))
            for c in range(95, 330) for t in range(pick.randint(1, 7)) if c not in (100, 103, 200)]
    rows += [(200, t, "user", "a") for t in range(2)]  # a base with fewer turns than asked for
    rows += [(c, t, "user", "same") for c in range(400, 460) for t in range(9)]  # copies
    rows += [(500, t, "user", str(t)) for t in range(70)] + [(600, t, "user", str(min(t, 30))) for t in range(40)]
    rows += [(c, t, "user", str(t) if t < 20 else f"{c}") for c in (502, 505, 509, 510, 599) for t in range(25)]
    rows += [(-5, 0, "user", "neg"), (-205, 1, "u", "x"), (700, None, "user", "first"), (700, 0, "user", "second")]
    rows += [(711, 0, "user", "only"), (712, 0, None, None), (713, 0, "", "")]  # no base 700 turns left for some
    rows += [(None, 0, "user", "lost"), (None, None, None, None), (800, 0, "user", "dup"), (800, 0, "user", "dup")]
    return rows + [(900, 0, "user", "y" * 200_000)]


@pytest.mark.parametrize("shallow,at_once", [(8, 200_000), (2, 200_000), (1, 10), (64, 10)])
def test_trie_equals_listing_every_prefix(spark, shallow, at_once):
    rows = odd_rows()
    table = spark.createDataFrame(rows, TABLE)
    got = listed(prefixes.trie(prefixes.rebuilt(table), shallow=shallow, turns_at_once=at_once))
    assert got == plain_trie(rows)


def test_many_copies_are_hashed_over_several_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(prefixes, "IDS_PER_CHUNK", 7)
    rows = [(c, 0, "user", "hello") for c in range(1000, 1990)] + [(c, 0, "user", f"t{c % 3}") for c in range(50)]
    spark.createDataFrame(rows, TABLE).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    assert listed(QUERIES["op13_prefix_trie"](spark, str(tmp_path))) == plain_trie(rows)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], TABLE)
    assert listed(prefixes.trie(prefixes.rebuilt(empty))) == []
    rows = odd_rows()[:200]
    extra = spark.createDataFrame([(*r, "x", 1, b"z") for r in rows], TABLE + ", id string, depth int, chain binary")
    assert listed(prefixes.trie(prefixes.rebuilt(extra))) == plain_trie(rows)
    only_null = spark.createDataFrame([(None, 1, "a", "b")], TABLE)
    assert listed(prefixes.trie(prefixes.rebuilt(only_null))) == []
