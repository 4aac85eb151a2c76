from __future__ import annotations

import random

import pytest
from postloom.operators import bulk
from postloom.operators.bulk import apply_bulk, bulk_rejects, repeated_seq

ACTION = "seq bigint, op string, id string, name string, price int"
ROW = "id string, name string, price int"


def step_by_step(base, actions):
    """What the log means, one action after the other."""
    state = {row[0]: list(row[1:]) for row in base}
    rejects = []
    for seq, op, key, *values in sorted(actions):
        known = key in state
        if op == "index" or (op == "create" and not known):
            state[key] = values
        elif op == "update" and known:
            state[key] = [new if new is not None else old for new, old in zip(values, state[key], strict=True)]
        elif op == "delete" and known:
            del state[key]
        else:
            rejects.append((seq, key))
    return {key: tuple(values) for key, values in state.items()}, sorted(rejects)


def run(spark, base, actions, block):
    base_df, action_df = spark.createDataFrame(base, ROW), spark.createDataFrame(actions, ACTION)
    state = {r.id: (r.name, r.price) for r in apply_bulk(base_df, action_df, "id", ["name", "price"], block=block).collect()}
    rejects = sorted((r.seq, r.id) for r in bulk_rejects(base_df, action_df, "id", block=block).collect())
    return state, rejects


def test_hand_worked(spark):
    actions = [
        (0, "create", "p1", "A", 10),
        (1, "update", "p1", None, 25),
        (2, "create", "p1", "again", 1),
        (3, "create", "s", "S", 1),
        (4, "delete", "s", None, None),
        (5, "index", "b", "B", 5),
        (6, "update", "s", "late", None),
        (7, "create", "s", "S2", 4),
    ]
    state, rejects = run(spark, [], actions, block=100)
    assert state == {"p1": ("A", 25), "b": ("B", 5), "s": ("S2", 4)}
    assert rejects == [(2, "p1"), (6, "s")]


def test_request_file_example(spark):
    base = [("1", "Noodles", 2000), ("joko2", "x", 1)]
    actions = [
        (1, "create", "joko", "Joko", None),
        (2, "index", "budi", "Budi", None),
        (3, "update", "1", None, 2500),
        (4, "create", "spammer", "Spammer", None),
        (5, "delete", "spammer", None, None),
    ]
    state, rejects = run(spark, base, actions, block=2)
    assert state == {"1": ("Noodles", 2500), "joko2": ("x", 1), "joko": ("Joko", None), "budi": ("Budi", None)}
    assert rejects == []


@pytest.mark.parametrize("seed", range(2))
def test_equals_step_by_step(spark, seed):
    """One key holds a third of the log; blocks are small, so lives span and split them."""
    rng = random.Random(seed)
    base = [(f"k{i}", f"base{i}", i) for i in range(8)]
    actions = []
    for seq in rng.sample(range(2000), 600):
        key = "k0" if rng.random() < 0.35 else f"k{rng.randrange(16)}"
        op = rng.choices(["create", "index", "update", "delete"], [2, 1, 6, 2])[0]
        name = rng.choice([None, f"n{seq}"])
        price = rng.choice([None, seq])
        actions.append((seq, op, key, name, price))
    for block in (7, 5000):
        assert run(spark, base, actions, block) == step_by_step(base, actions)


def test_unknown_action_and_repeated_seq(spark):
    rows = [(3, "drop", "a", None, None), (0, "index", "b", "B", 1), (2, "index", None, "N", 1)]
    rows += [(1, "index", "c", "C", 1), (1, "index", "d", "D", 1)]
    actions = spark.createDataFrame(rows, ACTION)
    base = spark.createDataFrame([("z", "Z", 1)], ROW)
    rejects = bulk_rejects(base, actions, "id").collect()
    assert sorted((r.op, r.reason) for r in rejects) == [
        ("drop", "unknown action"),
        ("index", "no key"),
        ("index", "repeated order"),
        ("index", "repeated order"),
    ]
    assert sorted(r.id for r in apply_bulk(base, actions, "id", ["name", "price"]).collect()) == ["b", "z"]
    assert [r.seq for r in repeated_seq(actions).collect()] == [1]


def test_actions_without_a_place_in_the_log_are_listed(spark):
    actions = [(1, "index", "a", "A", 1), (2, "index", "b", "B", 1), (2, "delete", "a", None, None)]
    actions += [(None, "index", "c", "C", 1), (3, "index", None, "N", 1), (None, "index", None, "N", 1)]
    base_df, action_df = spark.createDataFrame([("z", "Z", 9)], ROW), spark.createDataFrame(actions, ACTION)
    state = {r.id: r.name for r in apply_bulk(base_df, action_df, "id", ["name", "price"]).collect()}
    assert state == {"z": "Z", "a": "A"}
    rejects = sorted((r.reason, r.seq, r.id) for r in bulk_rejects(base_df, action_df, "id").filter("seq IS NOT NULL AND id IS NOT NULL").collect())
    assert rejects == [("repeated order", 2, "a"), ("repeated order", 2, "b")]
    reasons = sorted(r.reason for r in bulk_rejects(base_df, action_df, "id").collect())
    assert reasons == ["no key", "no key", "no order", "repeated order", "repeated order"]


def test_blocks_are_of_equal_depth(spark, monkeypatch):
    """One stray number far from all others makes no block larger; neither do bursts."""
    monkeypatch.setattr(bulk, "BLOCK", 10)
    numbers = [0, *(1_700_000_000_000_000 + k // 50 * 10**9 + k % 50 for k in range(200))]
    actions = [(n, "index", "hot", f"n{n}", 1) for n in numbers]
    action_df = spark.createDataFrame(actions, ACTION)
    judged = bulk._judged(spark.createDataFrame([], ROW), bulk._ordered(action_df, "id", "seq"), "id", [], "seq", bulk.BLOCK)
    sizes = [r["count"] for r in judged.groupBy("_block").count().collect()]
    assert sum(sizes) == 201 and max(sizes) <= 10
    state, rejects = run(spark, [], actions, None)
    assert state == {"hot": (f"n{numbers[-1]}", 1)} and rejects == []


def test_log_of_json_lines_for_several_tables(spark):
    lines = [
        '{"create": {"_index": "customers", "_id": "joko"}}',
        '{"name": "Joko"}',
        '{"index": {"_index": "customers", "_id": "budi"}}',
        '{"name": "Budi"}',
        '{"update": {"_index": "products", "_id": "1"}}',
        '{"doc": {"price": 2500}}',
        '{"delete": {"_index": "customers", "_id": "spammer"}}',
        '{"index": {"_index": "elsewhere", "_id": "x"}}',
        "not json",
    ]
    parsed = bulk.parse_bulk_log(spark.createDataFrame(list(enumerate(lines)), "line int, value string"), "name string, price int")
    tables = {
        "customers": spark.createDataFrame([("spammer", "S", None)], ROW),
        "products": spark.createDataFrame([("1", "Noodles", 2000)], ROW),
    }
    after = bulk.apply_bulk_log(tables, parsed, {"customers": ["name", "price"], "products": ["name", "price"]})
    assert {r.id: r.name for r in after["customers"].collect()} == {"joko": "Joko", "budi": "Budi"}
    assert [tuple(r) for r in after["products"].collect()] == [("1", "Noodles", 2500)]
    assert [r.id for r in bulk.unknown_tables(tables, parsed).collect()] == ["x"]
