from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest

from perkflow.llm import prefix_trie
from perkflow.llm.queries import op11_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, path string, mark string, node int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", "m", 1) for r in rows], SCHEMA)


def ordered(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append(((turn is not None, turn or 0, mark), (role, text)))
    return {conv: [t for _, t in sorted(turns)] for conv, turns in own.items()}


def rebuilt(own):
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        out[conv] = own.get(conv - conv % 5, [])[:h] + turns[h:]
    return out


def brute_force(paths):
    """Every node from all conversations, with no sharing of work."""
    members = defaultdict(list)
    for conv, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        return [node] + [x for child in children[node] for x in below(child)]

    out = []
    for node, convs in members.items():
        under = below(node)
        ends = ",".join(map(str, sorted(c for c in convs if len(paths[c]) == len(node))))
        saved = sum((len(members[x]) - 1) * (len(x[-1][1].encode()) if x else 0) for x in under)
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
            sum(not children[x] for x in under), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def result(nodes):
    return sorted((tuple(r) for r in nodes.select(prefix_trie.COLUMNS).collect()), key=repr)


def made(rng, n):
    """Conversations that share turns: a very common first turn, copies, turnless and long ones."""
    rows = []
    for conv in range(n):
        first = "hello" if rng.random() < 0.4 else rng.choice("abcd")
        turns = [first] + [rng.choice("xyz") for _ in range(rng.randint(0, 6))]
        if conv % 3 == 0:
            turns = ["hello", "x", "é" * 5]
        if conv == 7:
            turns = [rng.choice("xy") for _ in range(60)]
        for i, text in enumerate(turns):
            rows.append((conv, i, rng.choice(["user", None]) if i > 3 else "user", text))
    return rows


@pytest.mark.parametrize("shard_turns", [25, 90, 10_000])
def test_nodes_equal_brute_force_at_any_number_of_shards(spark, rng, shard_turns):
    rows = made(rng, 150)
    listed = prefix_trie.rebuilt_turns(frame(spark, rows))
    got = result(prefix_trie.trie(listed, shard_turns))
    assert got == brute_force(rebuilt(ordered(rows)))


def test_copies_of_one_conversation_lie_in_many_shards(spark):
    rows = [(conv, i, "user", t) for conv in range(400) for i, t in enumerate(["same", "text"])]
    table = prefix_trie.paths(prefix_trie.conversation_turns(frame(spark, rows)))
    frame_, shards = prefix_trie.skeleton(table, 40)
    assert shards > 10 and len({path for path, _ in frame_.splitters}) == 1
    got = result(prefix_trie.trie(prefix_trie.conversation_turns(frame(spark, rows)), 40))
    assert got == brute_force(ordered(rows))


def test_splitters_of_long_conversations_are_cut(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SPLIT_TURNS", 4)
    rows = [(conv, i, "user", str(i) if i < 9 else str(conv % 3)) for conv in range(40) for i in range(12)]
    listed = prefix_trie.conversation_turns(frame(spark, rows))
    sketch, shards = prefix_trie.skeleton(prefix_trie.paths(listed), 60)
    assert max(len(path) for path, _ in sketch.splitters) <= 4 * prefix_trie.WIDTH
    assert result(prefix_trie.trie(listed, 60)) == brute_force(ordered(rows))


def test_member_lists_of_skeleton_nodes_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 16)
    rows = [(conv, 0, "user", "one") for conv in range(120)]
    got = result(prefix_trie.trie(prefix_trie.conversation_turns(frame(spark, rows)), 30))
    assert got == brute_force(ordered(rows))


def test_edge_cases(spark):
    rows = [
        (10, None, "user", "null turn first"), (10, 0, None, None), (10, 3, "user", ""), (10, 3, "user", ""),
        (11, 1, "user", "b"), (11, 1, "user", "a"), (None, 0, "user", "no conversation"), (12, 0, "", None),
        (-7, 0, "user", "negative"), (23, 0, "user", "its first conversation is absent"),
        (14, 0, "user", "x" * 100_000),
    ]
    want = ordered(rows)
    got = result(prefix_trie.trie(prefix_trie.conversation_turns(frame(spark, rows)), 3))
    assert got == brute_force(want)
    empty = prefix_trie.trie(prefix_trie.rebuilt_turns(frame(spark, [])))
    assert empty.count() == 0


def test_a_rebuilt_conversation_may_have_no_turn(spark):
    # crc32("0") % 9 is 5: conversation 0 keeps its turns; find ones that lose all of theirs.
    lost = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:3]
    rows = [(c, i, "user", "t") for c in lost for i in range(2)]
    want = rebuilt(ordered(rows))
    assert [] in want.values()
    got = result(prefix_trie.trie(prefix_trie.rebuilt_turns(frame(spark, rows))))
    assert got == brute_force(want)


def test_nodes_name_their_last_turn(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, None, "there"), (2, 0, "user", "hi")]
    nodes = prefix_trie.trie(prefix_trie.conversation_turns(frame(spark, rows)))
    found = prefix_trie.with_texts(nodes, frame(spark, rows)).select("conv_id", "depth", "role", "text").collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == [(1, 0, None, None), (1, 1, "user", "hi"), (1, 2, "", "there")]


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(op11_prefix_trie(spark, sf_dir)) == brute_force(rebuilt(ordered(rows)))


def test_texts_do_not_move(spark, sf_dir):
    """Only marks and sizes are shuffled."""
    listed = prefix_trie.rebuilt_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
