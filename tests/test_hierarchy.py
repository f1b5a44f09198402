import random

import pytest

from lodestrata.operators.hierarchy import descendants, hierarchy


def brute(pairs):
    fold = lambda x: (x or "").strip().lower()
    ids = {fold(i) for i, _ in pairs if fold(i)}
    up = {fold(i): fold(p) if fold(p) in ids else None for i, p in pairs if fold(i)}
    out = {}
    for i in up:
        seen, x = [], i
        while up[x] is not None and x not in seen:
            seen.append(x)
            x = up[x]
        if up[x] is None:
            out[i] = (x, len(seen))
        else:
            loop = seen[seen.index(x) :]
            out[i] = (min(loop), -1 if i in loop else -2)
    return out


SCHEMA = "id string, parent_artifact_id string, root_id int, path string"


def run(spark, pairs):
    df = spark.createDataFrame([(i, p, 1, "x") for i, p in pairs], SCHEMA)
    return {r["id"]: (r["root_id"], r["node_depth"]) for r in hierarchy(df).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs_match_brute_force(spark, seed):
    rng = random.Random(seed)
    pairs = [(f"n{i:03d}", f"n{rng.randrange(120):03d}" if rng.random() < 0.9 else None) for i in range(100)]
    assert run(spark, pairs) == brute(pairs)


def test_long_chain_loops_and_dirt(spark):
    pairs = [(f"c{i:03d}", f"c{i - 1:03d}" if i else " ") for i in range(60)]
    pairs += [("self", "self"), ("a", "b"), ("b", "a"), ("below", " B "), ("lost", "nowhere"), ("a", "b"), (None, "a")]
    got = run(spark, pairs)
    assert got == brute(pairs)
    assert got["c059"] == ("c000", 59) and got["self"] == ("self", -1) and got["below"] == ("a", -2)


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_paths_and_descendants(spark):
    df = spark.createDataFrame([("r", None, 0, ""), ("k", "r", 0, ""), ("g", "K", 0, ""), ("x", "x", 0, "")], SCHEMA)
    paths = {r["id"]: r["path"] for r in hierarchy(df, with_path=True).collect()}
    assert paths == {"r": ["r"], "k": ["r", "k"], "g": ["r", "k", "g"], "x": None}
    assert {tuple(r) for r in descendants(df).collect()} == {("r", "k", 1), ("k", "g", 1), ("r", "g", 2)}


def test_hot_parent(spark):
    pairs = [("root", None)] + [(f"k{i}", "root") for i in range(3000)]
    assert run(spark, pairs) == brute(pairs)


def test_crowds_below_a_loop_and_a_deep_node(spark):
    """Chains that lead into one loop, and under one deep node: their far ancestors are hot, their direct parents are not."""
    chain = lambda name, top, n: [(f"{name}{k}", f"{name}{k - 1}" if k else top) for k in range(n)]
    pairs = [("la", "lb"), ("lb", "la"), *chain("deep", None, 12)]
    for i in range(400):
        pairs += chain(f"x{i:03d}_", "la", 4) + chain(f"y{i:03d}_", "deep11", 4)
    assert run(spark, pairs) == brute(pairs)
