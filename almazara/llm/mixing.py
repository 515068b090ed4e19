"""Problem 9: mixing sources to target weights.

Source weights are tempered shares; the exponent is found by bisection for a
target entropy or for the repetition limits. The weights are realised as
budgeted block permutations: whole passes over a source, and one partial pass in
hash order up to the rest of its budget, cut by prefix sums over hash buckets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almazara.runtime import materialize

#: Hash buckets of a pass over one source.
BUCKETS_LOG2 = 10
#: Blocks of the mixture, each holding every source in its weight.
BLOCKS = 64


def tempered(natural: dict[str, float], exponent: float, toward: dict[str, float] | None = None) -> dict[str, float]:
    """Normalised weights natural * (toward / natural) ** exponent; ``toward`` is the uniform mixture by default.

    Exponent 0 gives the natural shares, 1 the mixture aimed at. Sources without
    tokens or target have weight 0.
    """
    have = {s: p for s, p in natural.items() if p > 0 and (toward is None or toward.get(s, 0) > 0)}
    raw = {s: math.exp((1 - exponent) * math.log(p) + exponent * math.log(toward[s] if toward else 1.0)) for s, p in have.items()}
    total = sum(raw.values())
    return {s: raw.get(s, 0.0) / total if total else 0.0 for s in natural}


def entropy(weights: dict[str, float]) -> float:
    """Entropy of normalised weights, in nats."""
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def exponent_for_entropy(natural: dict[str, float], target: float) -> float:
    """Exponent between 0 and 1 whose tempered weights have the target entropy (the nearest end beyond it)."""
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if entropy(tempered(natural, mid)) < target else (low, mid)
    return high


def weights_within(tokens: dict[str, int], targets: dict[str, float], repeats: dict[str, int], total: float) -> tuple[dict[str, float], float]:
    """Weights nearest the targets, by the exponent, that draw ``total`` tokens within the repetition limits, and the exponent."""
    natural = {s: float(n) for s, n in tokens.items()}
    all_ = sum(n for s, n in natural.items() if targets.get(s, 0) > 0)
    natural = {s: (n / all_ if all_ and targets.get(s, 0) > 0 else 0.0) for s, n in natural.items()}
    fits = lambda w: all(w[s] * total <= repeats[s] * tokens[s] * (1 + 1e-12) for s in w)
    if fits(tempered(natural, 1.0, targets)):
        return tempered(natural, 1.0, targets), 1.0
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if fits(tempered(natural, mid, targets)) else (low, mid)
    return tempered(natural, low, targets), low


def largest_total(tokens: dict[str, int], targets: dict[str, float], repeats: dict[str, int]) -> float:
    """The most tokens at which every source with tokens can have exactly its (renormalised) target share."""
    here = {s: t for s, t in targets.items() if t > 0 and tokens.get(s, 0) > 0 and repeats[s] > 0}
    whole = sum(here.values())
    return min((repeats[s] * tokens[s] * whole / t for s, t in here.items()), default=0.0)


def corpus_total(sizes: DataFrame, targets: DataFrame) -> int:
    """Tokens of all documents of the sources that have a target and may be used."""
    aimed = targets.where((F.col("target_share") > 0) & (F.col("max_repeats") > 0)).select("source").distinct()
    return int(sizes.join(aimed, "source", "left_semi").agg(F.sum("tokens")).first()[0] or 0)


def budgets_within(weights: dict[str, float], limits: dict[str, int], total: float) -> dict[str, int]:
    """Tokens of each source: its weight of the total, and what limits keep back goes to the others in proportion."""
    budget, open_, left = dict.fromkeys(weights, 0), {s for s, w in weights.items() if w > 0}, total
    while open_ and left > 0.5:
        whole = sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] / whole * left >= limits[s] - budget[s]}
        if not full:
            return budget | {s: budget[s] + int(weights[s] / whole * left + 1e-6) for s in open_}
        for s in full:
            left -= limits[s] - budget[s]
            budget[s] = limits[s]
        open_ -= full
    return budget


def _plan(sizes: DataFrame, targets: DataFrame, total_tokens: float | None, target_entropy: float | None = None):
    rows = [r for r in targets.where(F.col("source").isNotNull()).collect()]
    share = {r.source: max(float(r.target_share or 0), 0.0) for r in rows}
    repeats = {r.source: max(int(r.max_repeats or 0), 0) for r in rows}
    share = {s: t if repeats[s] else 0.0 for s, t in share.items()}
    found = {r.source: r.tokens for r in sizes.where(F.col("source").isin(*share)).groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()} if share else {}
    tokens = {s: int(found.get(s, 0)) for s in share}
    if target_entropy is not None:
        natural = {s: float(n) if share[s] > 0 else 0.0 for s, n in tokens.items()}
        whole = sum(natural.values())
        natural = {s: n / whole if whole else 0.0 for s, n in natural.items()}
        share = tempered(natural, exponent_for_entropy(natural, target_entropy))
    total = largest_total(tokens, share, repeats) if total_tokens is None else min(total_tokens, sum(repeats[s] * tokens[s] for s in share if share[s] > 0))
    weights, exponent = weights_within(tokens, share, repeats, total)
    budget = budgets_within(weights, {s: repeats[s] * tokens[s] for s in share}, total)
    return share, repeats, tokens, budget, exponent


def _lookup(values: dict, kind: str) -> Column:
    return F.create_map(*[F.lit(x).cast(t) for s, v in values.items() for x, t in ((s, "string"), (v, kind))])[F.col("source")]


def draw_mixture(sizes: DataFrame, targets: DataFrame, *, total_tokens: float | None = None, target_entropy: float | None = None, seed: int = 42) -> DataFrame:
    """(source, doc_id, pass_number, tokens, block): the documents drawn, once for each pass they are in.

    ``sizes``: item_id, doc_id, source, tokens; ``targets``: source,
    target_share, max_repeats (a few rows). Without ``total_tokens`` the mixture
    is the largest in which every target is met; a larger total bends the
    weights toward the natural shares by the exponent until the limits hold; where
    they cannot, what limits keep back goes to the other sources. With
    ``target_entropy`` (nats) the shares aimed at are the tempered natural shares
    of that entropy, of the sources that have a target.
    Documents without a source or of a source without target are not drawn;
    a source without documents leaves its share to the others in proportion. A
    source's tokens stay within its budget by less than one document.
    """
    share, repeats, tokens, budget, _ = _plan(sizes, targets, total_tokens, target_entropy)
    used = {s: b for s, b in budget.items() if b > 0 and tokens[s] > 0}
    schema = "source string, doc_id long, pass_number int, tokens long, block int"
    if not used:
        return sizes.sparkSession.createDataFrame([], schema)
    passes = {s: used[s] // tokens[s] for s in used}
    rest = {s: used[s] - passes[s] * tokens[s] for s in used}
    rows = sizes.where(F.col("source").isin(*used)).select("source", "item_id", "doc_id", "tokens")
    last = _lookup(passes, "int") + F.when(_lookup(rest, "long") > 0, 1).otherwise(0)
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), last)).alias("pass_number")) if max(passes[s] + (rest[s] > 0) for s in used) else rows
    key = F.xxhash64(F.lit(seed), "pass_number", "item_id")
    rows = rows.withColumn("key", key).withColumn("bucket", F.shiftrightunsigned("key", 64 - BUCKETS_LOG2))
    sums = rows.groupBy("source", "pass_number", "bucket").agg(F.sum("tokens").alias("bucket_tokens"))
    order = Window.partitionBy("source", "pass_number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("bucket_tokens").over(order), F.lit(0)))
    partial = F.col("pass_number") > _lookup(passes, "int")
    left = F.when(partial, _lookup(rest, "long")).otherwise(F.lit(2**62))
    sums = sums.where(F.col("before") < left).withColumn("cut", F.col("before") + F.col("bucket_tokens") > left).withColumn("room", left - F.col("before"))
    # At most 1,024 rows for each pass of a source; written down, its size is known to Catalyst.
    sums = materialize(sums, "buckets")
    joined = rows.join(sums, ["source", "pass_number", "bucket"])
    whole = joined.where(~F.col("cut"))
    # Only the one bucket of a source in which its budget ends is put in order.
    run = F.sum("tokens").over(Window.partitionBy("source", "pass_number", "bucket").orderBy("key", "item_id").rowsBetween(Window.unboundedPreceding, 0))
    ends = joined.where("cut").withColumn("run", run).where(F.col("run") <= F.col("room")).drop("run")
    drawn = whole.unionByName(ends)
    at = ((F.col("pass_number") - 1) * _lookup(tokens, "long") + F.col("before")) / _lookup(used, "double")
    return drawn.select("source", "doc_id", F.col("pass_number").cast("int").alias("pass_number"), "tokens", F.least(F.floor(at * BLOCKS), F.lit(BLOCKS - 1)).cast("int").alias("block"))


def mixture_report(drawn: DataFrame, sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source of the targets: its target and actual share, tokens drawn and available, and most repeats used."""
    got = drawn.groupBy("source").agg(F.sum("tokens").alias("tokens_drawn"), F.max("pass_number").alias("repeats_used"), F.count("*").alias("records"))
    have = sizes.where(F.col("source").isNotNull()).groupBy("source").agg(F.sum("tokens").alias("tokens_available"))
    out = targets.where(F.col("source").isNotNull()).join(got, "source", "left").join(have, "source", "left")
    zero = F.lit(0).cast("long")
    out = out.select("source", "target_share", "max_repeats", F.coalesce("tokens_drawn", zero).alias("tokens_drawn"), F.coalesce("tokens_available", zero).alias("tokens_available"), F.coalesce("repeats_used", F.lit(0)).alias("repeats_used"), F.coalesce("records", zero).alias("records"))
    # The window is over the few rows of the targets.
    return out.withColumn("actual_share", F.col("tokens_drawn") / F.sum("tokens_drawn").over(Window.partitionBy(F.lit(1))))
