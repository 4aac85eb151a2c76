from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from oracle_check import difference
from postloom.llm import queries, tries


def plain_nodes(conversations):
    """``{id: [(role, text), ...]}`` to rows as :func:`tries.prefix_trie` gives them."""
    members = defaultdict(list)
    for i, turns in conversations.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(i)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path, ids in members.items():
        if path:
            children[path[:-1]] += 1
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += all(len(conversations[i]) == len(path) for i in ids)
            saved[path[:depth]] += (len(ids) - 1) * len(path[-1][1]) if path else 0
    rows = []
    for path, ids in members.items():
        ends = ",".join(str(i) for i in sorted(ids) if len(conversations[i]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        rows.append((len(path), min(ids), parent, len(ids), children[path], leaves[path], saved[path], digest))
    return sorted(rows, key=str)


def turn_table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, id int, turns string")


def nodes_of(df):
    return sorted(((*r[:7], r.ends.hex()) for r in df.collect()), key=str)


def some_conversations(rng, n):
    found = {}
    for i in rng.sample(range(-5, 1000), n):
        turns = [(rng.choice("ua"), "x" * rng.randrange(3)) for _ in range(rng.choice([0, 1, 2, 3, 5, 9, 30]))]
        found[i] = [("u", "same"), ("a", "start")] * rng.randrange(4) + turns
    hot = [("u", "hot"), ("a", "conversation")]
    found.update({2000 + i: hot for i in range(n // 2)})
    found.update({3000 + i: hot + [("u", "goes on")] for i in range(n // 8)})
    return found


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_equals_plain_version(spark, conf, monkeypatch, shards):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions=str(shards))
    found = some_conversations(random.Random(shards), 120)
    rows = [(i, t, role or None, text or None, 1, "clash") for i, turns in found.items() for t, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    got = nodes_of(tries.prefix_trie(tries.turn_sequences(turn_table(spark, rows))))
    assert got == plain_nodes({i: turns for i, turns in found.items() if turns})


def test_shards_and_borders_without_spark(monkeypatch):
    """Every way to cut the rows gives the same sums; tiny matrices and pieces."""
    monkeypatch.setattr(tries, "WIDTH", 2)
    monkeypatch.setattr(tries, "PIECE_IDS", 3)
    rng = random.Random(5)
    for _ in range(30):
        found = some_conversations(rng, rng.randrange(2, 40))
        if rng.random() < 0.2:
            found = {i: [] for i in found}
        number = {turn: (rng.randrange(-5, 5), j) for j, turn in enumerate({t for turns in found.values() for t in turns})}
        order = sorted(found, key=lambda i: ([number[t] for t in found[i]], i))
        cuts = sorted(rng.choices(range(len(order) + 1), k=rng.randrange(6)))
        records, borders = [], []
        for shard, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(order)], strict=True)):
            ids = order[lo:hi]
            rng.shuffle(ids)
            if not ids:
                continue
            offsets = np.cumsum([0] + [len(found[i]) for i in ids])
            turns = np.array([x for i in ids for t in found[i] for x in number[t]], dtype=np.int64)
            sizes = np.array([len(text) for i in ids for _, text in found[i]], dtype=np.int64)
            for record in tries.shard_records(shard, np.array(ids), offsets, turns, sizes):
                if record["kind"][0] == tries.BORDER:
                    borders += zip(record["turns"], record["sizes"], strict=True)
                else:
                    records.append(record)
        records += list(tries.border_records(iter(borders)))
        nodes, parts, parent_of = [], defaultdict(lambda: [None, None, 0, 0, 0, 0, []]), []
        for record in records:
            for i, kind in enumerate(record["kind"]):
                row = {name: values[i] for name, values in record.items()}
                figures = [int(row.get(c) or 0) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
                if kind == tries.FINAL:
                    nodes.append([int(row["depth"]), int(row["conv_id"]), row["parent_conv_id"], *figures, row["ends"].hex()])
                    parent_of.append((nodes[-1], row["parent_key"]))
                    continue
                part = parts[row["key"]]
                part[0] = int(row["depth"])
                if row.get("conv_id") is not None:
                    part[1] = min(int(row["conv_id"]), part[1] if part[1] is not None else 1 << 60)
                part[2:6] = [a + b for a, b in zip(part[2:6], figures, strict=True)]
                if row.get("ends"):
                    part[6].append((row["place"], row["ends"]))
                if row.get("parent_key"):
                    part.append(row["parent_key"])
        for part in parts.values():
            ends = b",".join(text for _, text in sorted(part[6]))
            nodes.append([part[0], part[1], None, *part[2:6], hashlib.sha256(ends).hexdigest()])
            parent_of.append((nodes[-1], part[7] if len(part) > 7 else None))
        for node, key in parent_of:
            if key is not None:
                node[2] = parts[key][1]
        assert sorted(map(tuple, nodes), key=str) == plain_nodes(found)


def test_edge_cases(spark):
    rows = [(1, None, "u", "a", 0, ""), (1, 0, "u", None, 0, ""), (1, 0, None, "b", 0, ""), (1, 0, None, "b", 0, ""), (None, 1, "u", "lost", 0, "")]
    rows += [(2, None, "u", "a", 0, ""), (3, 4, "u", "ä" * 70_000, 0, ""), (4, 1, "u", "", 0, ""), (5, 1, None, "u", 0, "")]
    got = nodes_of(tries.prefix_trie(tries.turn_sequences(turn_table(spark, rows))))
    first = [("u", "a"), ("", "b"), ("", "b"), ("u", "")]
    assert got == plain_nodes({1: first, 2: first[:1], 3: [("u", "ä" * 70_000)], 4: [("u", "")], 5: [("", "u")]})
    empty = turn_table(spark, [])
    assert tries.prefix_trie(tries.turn_sequences(empty)).collect() == []


def test_turnless(spark):
    rows = spark.createDataFrame([(3, []), (1, []), (10, [])], "id long, turns array<struct<h: long, g: long, size: long>>")
    assert nodes_of(tries.prefix_trie(rows)) == plain_nodes({3: [], 1: [], 10: []})


def test_rebuilt_conversations(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    own = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.turn):
        own[r.conv_id].append((r.role, r.text))
    found = {}
    for i, turns in own.items():
        h = zlib.crc32(str(i).encode()) % 6
        found[i] = own.get(i - i % 100, [])[:h] + turns[h:]
    got = queries.QUERIES["op13_conversations"](spark, sf_dir)
    got = got.select("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == plain_nodes(found)


def test_equals_sql(spark, sf_dir):
    assert difference(spark, sf_dir, "op13_conversations") is None
