import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from almazara.llm import mixing

SIZES = "item_id long, doc_id long, source string, tokens long"
TARGETS = "source string, target_share double, max_repeats int"


def corpus(spark, counts, seed=0, size=lambda r: r.randrange(1, 40)):
    rng = random.Random(seed)
    data = [(s, size(rng)) for s, n in counts.items() for _ in range(n)]
    return spark.createDataFrame([(i, i * 10, s, t) for i, (s, t) in enumerate(data)], SIZES).withColumn("bucket", F.lit("clash")).withColumn("key", F.lit(1))


@pytest.mark.parametrize("total", [None, 20_000, 10_000_000])
def test_shares_limits_and_repeats(spark, total):
    sizes = corpus(spark, {"big": 3000, "mid": 400, "small": 60, None: 50, "other": 100})
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 3), ("small", 0.2, 4)], TARGETS)
    drawn = mixing.draw_mixture(sizes, targets, total_tokens=total).collect()
    have = {r.source: r.t for r in sizes.where("source is not null").groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    used = Counter()
    per_doc = Counter((r.doc_id, r.source) for r in drawn)
    for r in drawn:
        used[r.source] += r.tokens
    assert set(used) <= {"big", "mid", "small"} and len({(r.doc_id, r.pass_number) for r in drawn}) == len(drawn)
    limit = {"big": 1, "mid": 3, "small": 4}
    assert all(n <= limit[s] for (_, s), n in per_doc.items())
    if total is None:
        assert min(abs(used[s] - limit[s] * have[s]) for s in limit) <= 40  # a limit binds: no larger mixture meets all targets
        assert all(abs(used[s] / sum(used.values()) - t) < 0.01 for s, t in (("big", 0.5), ("mid", 0.3), ("small", 0.2)))
    if total == 20_000:
        assert sum(used.values()) > 0.97 * min(total, sum(limit[s] * have[s] for s in limit))
    if total == 10_000_000:
        assert all(used[s] > 0.99 * limit[s] * have[s] - 40 for s in limit)


def test_blocks_hold_every_source_in_its_weight(spark):
    sizes = corpus(spark, {"a": 20_000, "b": 10_000})
    drawn = mixing.draw_mixture(sizes, spark.createDataFrame([("a", 0.7, 1), ("b", 0.3, 1)], TARGETS))
    shares = {r.block: r.s for r in drawn.groupBy("block").agg((F.sum(F.when(F.col("source") == "a", F.col("tokens"))) / F.sum("tokens")).alias("s")).collect()}
    assert len(shares) == mixing.BLOCKS and all(abs(s - 0.7) < 0.12 for s in shares.values())


def test_the_draw_is_the_same_for_any_partitioning(spark):
    sizes, targets = corpus(spark, {"a": 500, "b": 100}), spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 2)], TARGETS)
    first = sorted(map(tuple, mixing.draw_mixture(sizes.repartition(1), targets).collect()))
    assert first == sorted(map(tuple, mixing.draw_mixture(sizes.repartition(7), targets).collect()))


def test_missing_sources_and_empty_tables(spark):
    targets = spark.createDataFrame([("a", 0.5, 1), ("gone", 0.5, 1), ("never", 0.0, 3), ("zero", 0.1, 0), (None, 0.2, 1)], TARGETS)
    drawn = mixing.draw_mixture(corpus(spark, {"a": 50, "zero": 5, "never": 5}), targets)
    assert {r.source for r in drawn.collect()} == {"a"}
    report = {r.source: r for r in mixing.mixture_report(drawn, corpus(spark, {"a": 50}), targets).collect()}
    assert report["a"].actual_share == 1.0 and report["gone"].tokens_drawn == 0 and len(report) == 4
    assert mixing.draw_mixture(corpus(spark, {"a": 50}).limit(0), targets).count() == 0
    assert mixing.draw_mixture(corpus(spark, {"a": 50}), targets.limit(0)).count() == 0


def test_temperature():
    natural = {"a": 0.7, "b": 0.2, "c": 0.1}
    assert mixing.tempered(natural, 0.0) == pytest.approx(natural) and mixing.tempered(natural, 1.0) == pytest.approx(dict.fromkeys("abc", 1 / 3))
    target = 0.95
    e = mixing.exponent_for_entropy(natural, target)
    assert 0 < e < 1 and abs(mixing.entropy(mixing.tempered(natural, e)) - target) < 1e-9
    w, exponent = mixing.weights_within({"a": 700, "b": 200, "c": 100}, {"a": 0.2, "b": 0.2, "c": 0.6}, {"a": 1, "b": 1, "c": 2}, 800)
    assert 0 < exponent < 1 and sum(w.values()) == pytest.approx(1) and w["c"] * 800 == pytest.approx(200)


def test_a_mixture_of_the_corpus_size_bends_by_the_exponent(spark, tmp_path, monkeypatch):
    from almazara.llm import queries

    sizes, targets = corpus(spark, {"big": 3000, "small": 60, "other": 100}), spark.createDataFrame([("big", 0.8, 1), ("small", 0.2, 4)], TARGETS)
    targets.write.parquet(f"{tmp_path}/mix_targets.parquet")
    sizes.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries.tokens, "token_sizes", lambda documents: documents)
    have = {r.source: r.t for r in sizes.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    total = mixing.corpus_total(sizes, targets)
    assert total == have["big"] + have["small"] and 0 < mixing._plan(sizes, targets, total)[4] < 1
    used = Counter()
    for r in queries.QUERIES["p9_tempered"](spark, str(tmp_path)).collect():
        used[r.source] += r.tokens
    assert set(used) == {"big", "small"} and sum(used.values()) > 0.98 * total and abs(used["small"] - 4 * have["small"]) <= 40
    report = {r.source: r.tokens_drawn for r in queries.QUERIES["p9_tempered_shares"](spark, str(tmp_path)).collect()}
    assert report == used


def test_a_target_entropy_reaches_the_draw(spark):
    sizes, targets = corpus(spark, {"a": 3000, "b": 600, "c": 200, "other": 50}), spark.createDataFrame([("a", 0.9, 3), ("b", 0.05, 3), ("c", 0.05, 3)], TARGETS)
    used = Counter()
    for r in mixing.draw_mixture(sizes, targets, target_entropy=0.9).collect():
        used[r.source] += r.tokens
    assert set(used) == {"a", "b", "c"} and abs(mixing.entropy({s: n / sum(used.values()) for s, n in used.items()}) - 0.9) < 0.01
