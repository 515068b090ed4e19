"""Problem 8: items of varying length into containers of fixed capacity.

Dynamic programming over the global histogram of lengths chooses length buckets
that minimise padding. Inside each bucket items form token-budget batches, and
the room a batch leaves is given to batches of shorter buckets, best fit first.
All of this works on counts - a histogram no longer than the capacity - and ends
in a short table of rank ranges; the items, however many, find their container by
their rank in their bucket, which is taken in two levels, so that no bucket is
sorted or numbered in one task.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almazara.runtime import materialize

MAX_BUCKETS = 512
#: Parts of a bucket in which items are numbered side by side.
PARTS = 256
#: Steps of a capacity in which lengths are counted: one token each up to this many, wider ones beyond, lengths rounded up.
STEPS = 1_000_000


def bucket_bounds(histogram: dict[int, int], max_buckets: int = MAX_BUCKETS) -> list[int]:
    """Upper bounds of at most ``max_buckets`` length buckets with the least padding.

    Exact where every length can have its own bucket. Else the dynamic
    programme charges each bucket a price, found by bisection, at which the
    number of buckets fits; the cost of a bucket (items times its bound, less
    their lengths) lets each step look at the lower hull of lines only.
    """
    lengths = sorted(n for n, c in histogram.items() if c > 0)
    if len(lengths) <= max_buckets:
        return lengths
    count, total = [0], [0]
    for n in lengths:
        count.append(count[-1] + histogram[n])
        total.append(total[-1] + histogram[n] * n)

    def solve(price: float) -> list[int]:
        # best[j] = min over i of best[i] + price + length_j * (count_j - count_i) - (total_j - total_i)
        best, cut = [0.0], [0]
        hull, head = [0], 0
        line = lambda i: (-count[i], best[i] + total[i])
        for j in range(1, len(lengths) + 1):
            x = lengths[j - 1]
            while head + 1 < len(hull) and line(hull[head + 1])[0] * x + line(hull[head + 1])[1] <= line(hull[head])[0] * x + line(hull[head])[1]:
                head += 1
            i = hull[head]
            best.append(best[i] + price + x * (count[j] - count[i]) - (total[j] - total[i]))
            cut.append(i)
            while len(hull) - head >= 2:
                (a1, b1), (a2, b2), (a3, b3) = line(hull[-2]), line(hull[-1]), line(j)
                if (b3 - b1) * (a1 - a2) <= (b2 - b1) * (a1 - a3):
                    hull.pop()
                else:
                    break
            hull.append(j)
        bounds, j = [], len(lengths)
        while j > 0:
            bounds.append(lengths[j - 1])
            j = cut[j]
        return bounds[::-1]

    low, high = 0.0, float(lengths[-1] * count[-1] + 1)
    found = [lengths[-1]]
    for _ in range(60):
        price = (low + high) / 2
        bounds = solve(price)
        if len(bounds) <= max_buckets:
            found, high = bounds, price
        else:
            low = price
    return found


@dataclass(frozen=True)
class Batch:
    """Items of ranks ``first_item`` on of a bucket: ``per`` to each of ``containers`` containers from ``first``."""

    bound: int
    first_item: int
    items: int
    first: int
    per: int


def plan_batches(bucket_counts: dict[int, int], capacity: int) -> tuple[list[Batch], int]:
    """Batches of all buckets, longest first, and the number of containers.

    ``bucket_counts``: items by bucket bound. A bucket first fills the open
    containers whose room it fits best, then opens new ones.
    """
    rooms: list[int] = []
    open_: dict[int, list[tuple[int, int]]] = {}
    batches, used = [], 0

    def leave(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in open_:
                insort(rooms, room)
                open_[room] = []
            open_[room].append((first, n))

    for bound in sorted(bucket_counts, reverse=True):
        left, rank = bucket_counts[bound], 0
        while left:
            at = bisect_left(rooms, bound)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
            else:
                room, first, n = capacity, used, -(-left // (capacity // bound))
                used += n
            per = min(room // bound, left)
            full = min(n, left // per)
            batches.append(Batch(bound, rank, full * per, first, per))
            leave(room - per * bound, first, full)
            leave(room, first + full, n - full)
            rank, left = rank + full * per, left - full * per
    return batches, used


def pack_items(sizes: DataFrame, capacities: list[tuple[str, int]], *, max_buckets: int = MAX_BUCKETS) -> DataFrame:
    """(pack_name, container_id, doc_id, piece, start_token, tokens): every item's place for every capacity.

    ``sizes``: item_id, doc_id, tokens > 0. An item over the capacity is cut
    into pieces of the capacity, each alone in its container, and a rest that is
    packed like any item; no other item is cut. Every container's tokens are at
    most its capacity. Names must be distinct, capacities positive; an empty
    input gives no rows.
    """
    spark = sizes.sparkSession
    if len({n for n, _ in capacities}) != len(capacities) or any(c <= 0 for _, c in capacities):
        raise ValueError("pack names must be distinct and capacities positive")
    out = "pack_name string, container_id string, doc_id long, piece long, start_token long, tokens long"
    if not capacities:
        return spark.createDataFrame([], out)
    step = {n: -(-c // STEPS) for n, c in capacities}
    packs = F.array(*[F.struct(F.lit(n).alias("pack_name"), F.lit(c).cast("long").alias("capacity"), F.lit(step[n]).cast("long").alias("step")) for n, c in capacities])
    items = sizes.select("item_id", "doc_id", F.col("tokens").alias("all_tokens"), F.explode(packs).alias("p")).select("item_id", "doc_id", "all_tokens", "p.*")
    whole = F.when(F.col("all_tokens") > F.col("capacity"), F.floor(F.col("all_tokens") / F.col("capacity"))).otherwise(0).cast("long")
    items = items.withColumn("whole", whole).withColumn("size", F.col("all_tokens") - F.col("whole") * F.col("capacity"))
    # A length of a last, narrower step fills the container by itself.
    items = items.withColumn("steps", F.least(F.ceil(F.col("size") / F.col("step")), F.floor(F.col("capacity") / F.col("step"))))
    histogram = items.where(F.col("size") > 0).groupBy("pack_name", "steps").count().collect()
    class_rows, batch_rows = [], []
    for name, capacity in capacities:
        counts = {r["steps"]: r["count"] for r in histogram if r["pack_name"] == name}
        bounds = bucket_bounds(counts, max_buckets)
        by_bound: dict[int, int] = {}
        for n, c in counts.items():
            bound = bounds[bisect_left(bounds, n)]
            by_bound[bound] = by_bound.get(bound, 0) + c
            class_rows.append((name, n, bound))
        batches, _ = plan_batches(by_bound, capacity // step[name])
        batch_rows += [(name, b.bound, b.first_item, b.first_item + b.items, b.first, b.per) for b in batches]
    # Both tables are as long as the histogram at most, not as the data; written down, their size is known to Catalyst.
    classes = materialize(spark.createDataFrame(class_rows, "pack_name string, steps long, bound long").coalesce(1), "classes")
    batches = materialize(spark.createDataFrame(batch_rows, "pack_name string, bound long, from_rank long, to_rank long, first long, per long").coalesce(1), "batches")
    rest = items.where(F.col("size") > 0).join(classes, ["pack_name", "steps"]).withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(PARTS)))
    parts = rest.groupBy("pack_name", "bound", "part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("pack_name", "bound").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("pack_name", "bound", "part", before.alias("before"), "n")
    # The batches that a part's ranks meet, by part: the items themselves meet one row each.
    meets = (F.col("from_rank") < F.col("before") + F.col("n")) & (F.col("to_rank") > F.col("before"))
    parts = parts.join(batches, ["pack_name", "bound"]).where(meets).groupBy("pack_name", "bound", "part", "before").agg(F.collect_list(F.struct("from_rank", "to_rank", "first", "per")).alias("batches"))
    number = F.row_number().over(Window.partitionBy("pack_name", "bound", "part").orderBy("item_id"))
    ranked = rest.withColumn("number", number - 1).join(parts, ["pack_name", "bound", "part"]).withColumn("rank", F.col("before") + F.col("number"))
    own_batch = F.filter("batches", lambda b: (b["from_rank"] <= F.col("rank")) & (F.col("rank") < b["to_rank"]))[0]
    placed = ranked.withColumn("batch", own_batch).select("*", "batch.*")
    bin_ = (F.col("first") + F.floor((F.col("rank") - F.col("from_rank")) / F.col("per"))).cast("string")
    placed = placed.select("pack_name", F.concat(F.col("pack_name"), F.lit("-"), bin_).alias("container_id"), "doc_id", F.col("whole").alias("piece"), (F.col("whole") * F.col("capacity")).alias("start_token"), F.col("size").alias("tokens"))
    pieces = items.where(F.col("whole") > 0).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("piece"))
    own = F.concat("pack_name", F.lit("-item"), F.col("item_id").cast("string"), F.lit("-"), F.col("piece").cast("string"))
    pieces = pieces.select("pack_name", own.alias("container_id"), "doc_id", "piece", (F.col("piece") * F.col("capacity")).alias("start_token"), F.col("capacity").alias("tokens"))
    return placed.unionByName(pieces)


def pack_report(packed: DataFrame, capacities: list[tuple[str, int]]) -> DataFrame:
    """Per capacity: containers, tokens, items, the fill reached and the fullest container."""
    caps = F.create_map(*[F.lit(x) for n, c in capacities for x in (n, c)])
    containers = packed.groupBy("pack_name", "container_id").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("pieces"))
    out = containers.groupBy("pack_name").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.sum("pieces").alias("pieces"), F.max("tokens").alias("fullest"))
    return out.withColumn("capacity_tokens", caps[F.col("pack_name")]).withColumn("fill", F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")))
