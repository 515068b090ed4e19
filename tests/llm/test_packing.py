import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from almazara.llm import packing

SCHEMA = "item_id long, doc_id long, tokens long"


def check(spark, sizes, capacities, **options):
    df = spark.createDataFrame([(i, 10 * i, n) for i, n in enumerate(sizes)], SCHEMA).withColumn("size", F.lit("clash")).withColumn("part", F.lit(0))
    rows = packing.pack_items(df, capacities, **options).collect()
    for name, capacity in capacities:
        mine = [r for r in rows if r.pack_name == name]
        bins = {}
        for r in mine:
            bins[r.container_id] = bins.get(r.container_id, 0) + r.tokens
        assert all(0 < t <= capacity for t in bins.values())
        for i, n in enumerate(sizes):
            pieces = sorted((r.start_token, r.tokens) for r in mine if r.doc_id == 10 * i)
            assert sum(t for _, t in pieces) == n and (n > capacity or len(pieces) == 1)
            assert [s for s, _ in pieces] == [sum(t for _, t in pieces[:k]) for k in range(len(pieces))]
        yield name, len(bins), -(-sum(sizes) // capacity)


@pytest.mark.parametrize("max_buckets", [512, 12])
def test_every_item_once_and_no_container_over(spark, max_buckets):
    rng = random.Random(1)
    sizes = [max(1, int(rng.lognormvariate(4, 1))) for _ in range(3000)] + [1000, 1001, 512, 513, 5000]
    for name, used, least in check(spark, sizes, [("a", 512), ("b", 2048)], max_buckets=max_buckets):
        # Room is lost to padding alone: items count as their bucket's bound.
        capacity = {"a": 512, "b": 2048}[name]
        rests = [n if n <= capacity else n % capacity for n in sizes]
        bounds = packing.bucket_bounds(Counter(r for r in rests if r), max_buckets)
        padding = sum(min(b for b in bounds if b >= r) - r for r in rests if r)
        assert used <= (least + padding / capacity) * 1.01 + 2


@pytest.mark.parametrize("sizes", [[], [1], [7] * 500, [512] * 3, [257] * 9, [1024], [1] * 2000 + [511] * 10])
def test_ties_and_edges(spark, sizes):
    for _, used, least in check(spark, sizes, [("a", 512)]):
        assert used <= max(2 * least, 1) and (sizes or used == 0)


def test_buckets_are_optimal_against_brute_force():
    from itertools import combinations

    rng = random.Random(2)
    for _ in range(30):
        hist = {n: rng.randrange(1, 20) for n in rng.sample(range(1, 60), 9)}
        lengths = sorted(hist)
        cost = lambda bounds: sum(c * (min(b for b in bounds if b >= n) - n) for n, c in hist.items())
        for k in (2, 3, 5):
            found = packing.bucket_bounds(hist, k)
            best = min(cost((*c, lengths[-1])) for c in combinations(lengths[:-1], len(found) - 1))
            assert len(found) <= k and found[-1] == lengths[-1] and cost(found) == best
    assert packing.bucket_bounds({}, 4) == [] and packing.bucket_bounds({5: 2}, 4) == [5]


def test_bad_capacities(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        packing.pack_items(df, [("a", 0)])
    with pytest.raises(ValueError):
        packing.pack_items(df, [("a", 5), ("a", 6)])
    assert packing.pack_items(df, []).count() == 0


def test_report(spark):
    df = spark.createDataFrame([(0, 1, 6), (1, 2, 4), (2, 3, 5)], SCHEMA)
    (r,) = packing.pack_report(packing.pack_items(df, [("a", 10)]), [("a", 10)]).collect()
    assert (r.containers, r.tokens, r.fullest, r.fill) == (2, 15, 10, 0.75)


def test_very_large_capacities(spark):
    sizes = [2_999_999, 1_500_000, 1_499_999, 3, 3_000_001, 6_000_000, 700_000, 2]
    for _, used, least in check(spark, sizes, [("a", 3_000_000)]):
        assert used <= least + 1
