import zlib
from collections import Counter, defaultdict

import pytest
from helpers import WORD, rows, table

from lakeweave.llm import mixing, sharding
from lakeweave.llm.common import Workspace


def expected_targets(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    """Shares anew, round by round, as long as any is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest, total = goal - sum(fixed.values()), sum(w[s] for s in free)
        above = [s for s in free if rest * w[s] / total > repeats * sizes[s]]
        if not above:
            return fixed | {s: rest * w[s] / total for s in free}
        fixed |= {s: repeats * sizes[s] for s in above}


@pytest.mark.parametrize("block", [7, 1024])
def test_mix(spark, block):
    size = lambda t: len(WORD.findall(t or ""))
    sizes = defaultdict(int)
    for _, t, s in rows():
        sizes[s] += size(t)
    want = expected_targets(sizes)
    got = [r.asDict() for r in mixing.mix_documents(table(spark), block_words=block).collect()]
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, *_ in rows()) and set(got[0]) == {"doc_id", "size", "source_size", "target", "taken"}
    source = {i: (s, size(t)) for i, t, s in rows()}
    taken = defaultdict(int)
    for r in got:
        s, n = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (n, sizes[s]) and r["target"] == pytest.approx(want[s]) and 0 <= r["taken"] <= 2 * n
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = [r.asDict() for r in mixing.mix_documents(table(spark).repartition(5), block_words=block).collect()]
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_any_stretch_of_the_schedule_is_mixed(spark):
    data = [(i, " ".join(f"t{i}x{j}" for j in range(50)), "ab"[i % 2]) for i in range(200)]
    _, pieces = mixing.mix(table(spark, data), block_words=10)
    slots = [(r.slot, r._no) for r in pieces.select("slot", "_no").distinct().collect()]
    first = [no for slot, no in slots if slot < max(s for s, _ in slots) / 10]
    everything = Counter(no for _, no in slots)
    assert abs(Counter(first)[0] / len(first) - everything[0] / len(slots)) < 0.03


def test_copies_and_empty_mixes(spark):
    got = mixing.mixed_copies(table(spark))
    assert got.columns == table(spark).columns and max(Counter(r.doc_id for r in got.collect() if r.doc_id != 109).values()) <= 2
    assert mixing.mix_documents(table(spark, [])).collect() == []
    assert [tuple(r) for r in mixing.mix_documents(table(spark, [(1, None, "a"), (2, "", None)])).select("doc_id", "size", "target", "taken").orderBy("doc_id").collect()] == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_copies_come_near_the_targets(spark):
    r = __import__("random").Random(6)
    data = [(i, " ".join(["w"] * r.randint(1, 60)), "abc"[i % 7 % 3]) for i in range(400)]
    sizes = Counter()
    for _, t, s in data:
        sizes[s] += len(t.split())
    kept = Counter()
    for x in mixing.mixed_copies(table(spark, data), block_words=16).collect():
        kept[x.source] += len(x.text.split())
    want = expected_targets(sizes)
    # whole documents: no further off than a few that stand at block borders
    assert all(abs(kept[s] - want[s]) <= 0.05 * want[s] + 60 for s in want)


def test_what_grows_is_not_broadcast_by_estimate(spark, monkeypatch):
    """Without the tables of sources no join of the mix goes by what Spark estimates, and the mix is the same."""
    plans, put = [], Workspace.put
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    data = rows() + [(1000 + i, None if i % 3 else " ".join(["w"] * i), "s" if i % 5 else None) for i in range(60)]
    want = sorted(map(tuple, mixing.mixed_copies(table(spark, data), block_words=16).collect()), key=str)
    sized = sorted(map(tuple, mixing.mix_documents(table(spark, data), block_words=16).collect()), key=str)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    monkeypatch.setattr(Workspace, "put", lambda self, df, name: (plans.append((name, plan(df))), put(self, df, name))[1])
    got = mixing.mixed_copies(table(spark, data), block_words=16)
    plans.append(("copies", plan(got)))
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert sorted(map(tuple, mixing.mix_documents(table(spark, data), block_words=16).collect()), key=str) == sized
    plans.append(("slots", plan(sharding.shard_documents(table(spark, data)))))
    assert [n for n, p in plans if "BroadcastHashJoin" in p] == [] and sum("SortMergeJoin" in p for _, p in plans) > 3


def plain_winner(key, children):
    """The child with the least -ln(u) / weight, u from the hash of key and name as Spark chains them."""
    import math

    import xxhash

    def draw(name, weight):
        h = xxhash.xxh64_intdigest(name.encode(), xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42))
        return -math.log(((h >> 11) + 0.5) / (1 << 53)) / weight

    return min((c for c in children if c[1] > 0), key=lambda c: draw(*c))[0]


def plain_descent(key, tree):
    weight = lambda node: sum(map(weight, node.values())) if isinstance(node, dict) else node
    path, node = [], tree
    while isinstance(node, dict):
        names = {"/".join(map(str, [*(path or [""]), name])): name for name in node}
        last = names[plain_winner(key, [(p, weight(node[n])) for p, n in names.items()])]
        path, node = [*path, last], node[last]
    return last


def test_descent_equals_a_plain_one(spark):
    tree = sharding.balanced_tree(40)
    uneven = {"r1": {"a": {0: 1.0, 1: 3.0}, "b": {2: 2.0}}, "r2": {"c": {3: 2.0, 4: 0.0}}}
    for t in (tree, sharding.grown_tree(tree), uneven):
        got = sharding.place(spark.range(-50, 250), "id", t).collect()
        assert [r.shard for r in got] == [plain_descent(r.id, t) for r in got]


def test_shards(spark):
    got = sharding.shard_documents(table(spark)).collect()
    slots = defaultdict(list)
    text = {i: t or "" for i, t, _ in rows()}
    for r in got:
        slots[r.shard].append(r.slot)
        assert (r.size, r.text_crc32, r.law) == (len(text[r.doc_id].encode()) + 16, zlib.crc32(text[r.doc_id].encode()), "key")
        assert r.grown_shard in (r.shard, 40)
    assert len(got) == len(rows()) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.shard_documents(table(spark, [])).collect() == []


def test_keys_follow_weights_and_move_only_into_what_grew(spark):
    ids = spark.range(40_000)
    tree = {"r1": {"a": {0: 1.0, 1: 3.0}, "b": {2: 2.0}}, "r2": {"c": {3: 2.0, 4: 0.0}}}
    placed = sharding.place(sharding.place(ids, "id", tree, "x"), "id", sharding.grown_tree(tree, 2.0), "y")
    count = Counter(r.x for r in placed.collect())
    assert all(abs(count[s] / 40_000 - w / 8) < 0.01 for s, w in enumerate((1, 3, 2, 2))) and 4 not in count
    assert all(r.y in (r.x, 5) for r in placed.collect()) and abs(Counter(r.y for r in placed.collect())[5] / 40_000 - 0.2) < 0.01
    heavier = {"r1": {"a": {0: 1.0, 1: 3.0}, "b": {2: 4.0}}, "r2": tree["r2"]}
    moved = sharding.place(sharding.place(ids, "id", tree, "x"), "id", heavier, "y").where("x <> y").collect()
    assert {r.y for r in moved} <= {0, 1, 2} and all(not (r.x in (0, 1) and r.y in (0, 1)) for r in moved)
