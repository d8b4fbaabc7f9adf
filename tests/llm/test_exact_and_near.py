import hashlib
from collections import defaultdict

import pytest
from helpers import lower, rows, shingles, table, thue_morse
from pyspark.sql import functions as F

from lakeweave.llm import common, exact_dedup, near_dedup
from lakeweave.llm.common import Workspace
from lakeweave.llm.components import components


def expected_copies(data):
    groups = defaultdict(list)
    for i, text, *_ in data:
        groups[lower(text)].append(i)
    keep = {t: max((x for x in ids if x is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, keep[lower(t)], len(groups[lower(t)]), i == keep[lower(t)], hashlib.sha256(lower(t).encode()).hexdigest()) for i, t, *_ in data), key=str)


def test_exact(spark):
    got = exact_dedup.group_copies(table(spark))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected_copies(rows())
    assert exact_dedup.group_copies(table(spark, [])).collect() == []


def test_exact_when_buckets_overflow_and_hashes_collide(spark):
    key = lambda c: F.pmod(F.length(c), F.lit(3)).cast("long")  # noqa: E731  three keys for all texts
    weak = lambda c: F.encode(F.substring(F.sha2(c, 256), 1, 1), "UTF-8")
    for how in ({"capacity": 2}, {"capacity": 1, "key": key}, {"key": key, "digest": weak}, {"hot_rows": 1, "capacity": 2}, {"hot_rows": 3, "capacity": 1, "key": key, "digest": weak}):
        got = exact_dedup.group_copies(table(spark), **how)
        assert sorted(map(tuple, got.collect()), key=str) == expected_copies(rows())


def test_directory_splits_by_leading_bits(spark):
    keys = spark.range(500).select(F.xxhash64("id").alias("key"))
    buckets = exact_dedup.directory(keys, 20)
    sizes = defaultdict(int)
    for r in exact_dedup.with_bucket(keys, buckets).collect():
        b = buckets[r["bucket"]]
        assert (r["key"] % (1 << 64)) >> (64 - b.depth) == b.prefix
        sizes[r["bucket"]] += 1
    assert sum(sizes.values()) == 500 and max(sizes.values()) <= 20 and sum(2.0**-b.depth for b in buckets) == 1


def test_rows_are_found_through_the_directory_only(spark, monkeypatch):
    whole = exact_dedup.directory
    monkeypatch.setattr(exact_dedup, "directory", lambda keys, capacity: whole(keys, capacity)[1:])
    got = exact_dedup.group_copies(table(spark), capacity=5)
    assert 0 < len(got.collect()) < len(rows())  # those of the bucket that is gone are lost


def test_dropping_copies(spark):
    got = exact_dedup.drop_copies(table(spark))
    assert got.columns == table(spark).columns
    assert len(got.collect()) == len({lower(t) for _, t, _ in rows()})


def expected_groups(data):
    sets = [shingles(t) for _, t, _ in data]
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i, (d, *_) in enumerate(data):
        members[find(i)].append(d)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return sorted(((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, *_) in enumerate(data)), key=str)


def test_near(spark):
    got = near_dedup.near_groups(table(spark))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == expected_groups(rows())


def plain_kept(data):
    """How many rows of each group, and of texts without words, stay."""
    groups = {c for (i, n, c, _) in expected_groups(data) if n and c is not None}
    return len(groups), sum(not shingles(t) for _, t, _ in data)


REPEATED = [(5, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 w16 w17 w18 w19 w20", "s"), (5, "other words that nobody else has in any of these rows at all", "s"), (9, "other words that nobody else has in any of these rows at all", "s"), (None, "a text that only rows without ids have here", "s")]


def test_near_with_repeated_ids(spark):
    data = [(1, REPEATED[0][1] + " w21", "s"), *REPEATED, (5, REPEATED[0][1], "s"), (None, REPEATED[1][1].upper(), "s"), (7, "", "s"), (7, None, "s")]
    got = near_dedup.near_groups(table(spark, data))
    assert sorted(map(tuple, got.collect()), key=str) == expected_groups(data)
    left = near_dedup.drop_near(table(spark, data))
    assert left.columns == table(spark, data).columns
    # one text of each group, the ids' other texts gone; blank ones stay
    assert sorted(((r.doc_id, (r.text or "")[:5]) for r in left.collect()), key=str) == sorted([(1, "w1 w2"), (5, "other"), (None, "a tex"), (7, ""), (7, "")], key=str)


def test_dropping_near_copies(spark):
    data = [x for x in rows() if x[0] is not None]
    left = near_dedup.drop_near(table(spark, data)).collect()
    groups, blank = plain_kept(data)
    assert sum(bool(shingles(r.text)) for r in left) == groups and sum(not shingles(r.text) for r in left) == blank
    assert near_dedup.drop_near(table(spark, [])).collect() == []


def test_near_keeps_what_a_polynomial_hash_confuses_apart(spark):
    data = [(i, t, "s") for i, t in enumerate(thue_morse())]
    assert sorted(map(tuple, near_dedup.near_groups(table(spark, data)).collect())) == expected_groups(data) == [(0, 1, 0, True), (1, 1, 1, True)]


@pytest.mark.parametrize("how", [{}, {"block": 7, "group_members": 9, "group_words": 1500}, {"block": 20, "group_members": 16, "group_words": 100_000}])
def test_large_families_in_small_blocks(spark, how):
    import random

    r, data = random.Random(3), []
    for f in range(6):
        base = [f"f{f - f % 2 if i < 80 else f}w{i}" for i in range(120)]  # every other family shares two thirds of its words with the one before
        for c in range(40):
            words = list(base)
            for _ in range(c % 5):
                words[r.randrange(120)] = f"e{f}x{c}x{r.random()}"
            data.append((f * 1000 + c, " ".join(words), "s"))
    got = near_dedup.near_groups(table(spark, data), **how)
    assert sorted(map(tuple, got.collect()), key=str) == expected_groups(data)


def test_no_pair_at_the_threshold_is_lost_by_its_sketches():
    """100,000 pairs at similarity 0.75: each MinHash sample agrees with that chance."""
    import numpy as np

    rng = np.random.default_rng(9)
    lost = 0
    for _ in range(100):
        one = rng.integers(0, 1 << 32, (1000, near_dedup.SAMPLES), dtype=np.uint32)
        other = np.where(rng.random(one.shape) < 0.75, one, rng.integers(0, 1 << 32, one.shape, dtype=np.uint32))
        a, b = (np.stack([near_dedup.odd_sketch(x) for x in y]) for y in (one, other))
        flips = near_dedup._COUNT[a ^ b].sum(axis=1, dtype=np.int64)
        lost += int((near_dedup._ESTIMATE[flips] < near_dedup.SKETCH_AT).sum())
    assert lost == 0


def test_near_in_small_blocks_and_empty(spark):
    got = near_dedup.near_groups(table(spark), block=3, group_members=4, group_words=200)
    assert sorted(map(tuple, got.collect()), key=str) == expected_groups(rows())
    assert near_dedup.near_groups(table(spark, [])).collect() == []


def test_sketches_estimate_high_similarities():
    import numpy as np

    rng = np.random.default_rng(1)
    for share in (0.6, 0.75, 0.9):
        errors = []
        for _ in range(30):
            both, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (round(1000 * share), round(500 * (1 - share)), round(500 * (1 - share))))
            x, y = (near_dedup.odd_sketch(near_dedup.samples(np.concatenate([both, own]))) for own in (a, b))
            errors.append(near_dedup.estimate(x, y[None])[0] - share)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.05


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 30)] + [(100, 103), (103, 101), (7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long"), Workspace(spark)).collect()))
    assert found == {i: 0 for i in range(31)} | {100: 100, 101: 100, 103: 100}


def test_components_by_steps_and_in_one_task(spark):
    links = spark.createDataFrame([(i, i * 7 % 101) for i in range(90)] + [(500, 400), (400, 500), (9, 9)], "a long, b long")
    ways = [sorted(map(tuple, components(links, Workspace(spark), few=few).collect())) for few in (0, 10**6)]
    assert ways[0] == ways[1] and len({c for _, c in ways[0]}) > 2
    assert components(links.where("a = b"), Workspace(spark)).collect() == []


def test_what_grows_is_not_broadcast_by_estimate(spark, monkeypatch):
    """Spark takes an exploded table for as small as the file it was read from."""
    plans, put = [], Workspace.put
    monkeypatch.setattr(common, "HOT", 1)
    monkeypatch.setattr(Workspace, "put", lambda self, df, name: (plans.append((name, df._jdf.queryExecution().executedPlan().toString())), put(self, df, name))[1])
    data = rows() + [(1000 + i, f"{i % 9} " + " ".join(f"x{(i // 30) * 1000 + j}" for j in range(80)), "s") for i in range(90)]
    got = near_dedup.near_groups(table(spark, data), block=8, group_members=8)
    plans.append(("groups", got._jdf.queryExecution().executedPlan().toString()))
    assert sorted(map(tuple, got.collect()), key=str) == expected_groups(data)
    components(spark.createDataFrame([(1, 2), (2, 3)], "a long, b long"), Workspace(spark), few=0).collect()
    near_dedup.drop_near(table(spark, data)).collect()
    assert [n for n, p in plans if "BroadcastHashJoin" in p] == [] and sum("SortMergeJoin" in p for _, p in plans) > 5


def test_links_of_low_estimate_are_kept(spark):
    import random

    data = []
    for seed in (4654, 6946):  # pairs at 0.75 whose sketches estimate 0.61
        r = random.Random(seed)
        w = [f"w{r.randrange(10**9)}" for _ in range(84)]
        data += [(seed, " ".join(w[:74]), "s"), (seed + 1, " ".join(w[:64] + w[74:]), "s")]
    got = near_dedup.near_groups(table(spark, data)).collect()
    assert sorted(map(tuple, got), key=str) == expected_groups(data)
    assert {r.doc_id: r.component_id for r in got} == {4654: 4654, 4655: 4654, 6946: 6946, 6947: 6946}
