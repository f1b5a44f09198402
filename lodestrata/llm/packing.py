"""Items packed into containers of fixed capacity: configuration LP over the length histogram.

The lengths' histogram (at most `capacity` bars, whatever the number of items) is all that the driver sees. Lengths are put
into classes of at most 1 % (exact below 100); an item takes its class's largest length. The configuration LP, least
containers such that every class is covered, is solved by multiplicative weights on the classes: they play against the fillings
found so far, which yields prices for the classes, and knapsack dynamic programming looks for the filling of one container that pays
most at these prices. It joins the fillings, until none pays more than GAP over what a container costs. Prices divided by the
best pay are a solution of the dual, so their total is a lower bound on the containers that any packing of the classes needs.

The fractional solution is scaled until every class is covered and rounded down to whole containers; what is left is placed
largest class first. The fillings that this placing alone would use take part from the start.

Items are matched with slots without gathering them: an item's rank within its class, by range-partitioned sorting with
partition offsets, decides its filling and container by arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import running_totals

CAPACITY = 8192
#: At most so many fillings are priced; earlier the program ends within GAP of its lower bound. STEPS of weights between two.
ROUNDS, GAP, STEPS = 60, 0.002, 800


def classes(lengths: np.ndarray) -> np.ndarray:
    """For each of the distinct lengths, in ascending order, its class's size: the largest length of the class."""
    size = np.empty_like(lengths)
    i = 0
    while i < len(lengths):
        j = np.searchsorted(lengths, max(lengths[i], int(lengths[i] * 1.01)), side="right")
        size[i:j] = lengths[j - 1]
        i = j
    return size


def best_filling(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """(how many of each class, their total price) of the best-paid filling of one container: unbounded knapsack."""
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1, np.int64)
    first = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(int(sizes[0]), capacity + 1):
        n = first[c]
        offers = value[c - sizes[:n]] + prices[:n]
        k = int(offers.argmax())
        if offers[k] > value[c - 1]:
            value[c], choice[c] = offers[k], k
        else:
            value[c] = value[c - 1]
    counts = np.zeros(len(sizes), np.int64)
    c = capacity
    while c >= sizes[0]:
        if choice[c] < 0:
            c -= 1
            continue
        counts[choice[c]] += 1
        c -= int(sizes[choice[c]])
    return counts, float(value[capacity])


def largest_first(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """(containers, filling) that hold all items: each container takes as many of the largest classes left as fit."""
    plan, left = [], left.copy()
    while left.sum() > 0:
        room, filling = capacity, np.zeros(len(sizes), np.int64)
        for k in range(len(sizes) - 1, -1, -1):
            if left[k] and sizes[k] <= room:
                filling[k] = min(left[k], room // sizes[k])
                room -= int(filling[k] * sizes[k])
        on = filling > 0
        whole = int((left[on] // filling[on]).min())
        plan.append((whole, filling))
        left -= whole * filling
    return plan


def weights_game(rates: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(shares of the fillings, weights of the classes): the classes multiply up the weights of what is covered least, the
    fillings answer with the one that covers most weight. rates: filling x class, share of the class in one container."""
    rates = rates / rates.max()
    cover, chosen, sum_weight = np.zeros(rates.shape[1]), np.zeros(len(rates)), np.zeros(rates.shape[1])
    for k in range(1, steps + 1):
        weight = np.exp(-np.sqrt(np.log(len(cover) + 1) / k) * 4 * (cover - cover.min()) / max(rates.mean() * 4, 1e-12) ** 0.5)
        weight /= weight.sum()
        best = int((rates @ weight).argmax())
        chosen[best] += 1
        cover += rates[best]
        sum_weight += weight
    return chosen / steps, sum_weight / steps


def solve(sizes: np.ndarray, numbers: np.ndarray, capacity: int, rounds: int = ROUNDS, gap: float = GAP) -> tuple[list[tuple[int, np.ndarray]], float]:
    """([(containers, items of each class per container)], lower bound) that together hold all items; sizes ascend, none exceeds
    capacity.

    Only the last slots of a class may stay empty, by as many as are provided in excess.
    """
    numbers = numbers.astype(np.int64)
    on = numbers > 0
    if not on.any():
        return [], 0.0
    used_sizes, need = sizes[on], numbers[on]
    widen = lambda f: np.bincount(np.flatnonzero(on), f, len(sizes)).astype(np.int64)
    simple = largest_first(used_sizes, need, capacity)
    fillings = [f for _, f in simple] + [np.eye(len(need), dtype=np.int64)[k] * min(int(need[k]), capacity // int(used_sizes[k])) for k in range(len(need))]
    known = {f.tobytes() for f in fillings}
    lower = float((used_sizes * need).sum() / capacity)
    price, best = used_sizes / capacity, np.array([float(n) for n, _ in simple])
    for _ in range(rounds):
        filling, pay = best_filling(used_sizes, price, capacity)
        lower = max(lower, float(price @ need) / pay)
        if best.sum() <= max(lower * (1 + gap), np.ceil(lower - 1e-9)):
            break
        if filling.tobytes() not in known:
            known.add(filling.tobytes())
            fillings.append(filling)
        rates = np.array(fillings) / need
        shares, weight = weights_game(rates, STEPS)
        # Scaled so that every class is covered.
        covered = float((shares @ rates).min())
        if covered > 0 and 1 / covered < best.sum():
            best = shares / covered
        price = weight / need
    left, plan = need.copy(), []
    for k in np.argsort(-best, kind="stable"):
        f = fillings[k]
        whole = int(min(np.floor(best[k] + 1e-9), (left[f > 0] // f[f > 0]).min()))
        if whole:
            plan.append((whole, f))
            left -= whole * f
    plan += largest_first(used_sizes, left, capacity)
    plan = min(plan, simple, key=lambda p: sum(n for n, _ in p))  # rounding can lose what the program gained
    return [(n, widen(f)) for n, f in plan], lower


def _sizes(items: DataFrame, item: str, size: str, capacity: int) -> DataFrame:
    slim = items.select(F.col(item).alias("item"), F.greatest(F.coalesce(F.col(size).cast("bigint"), F.lit(0)), F.lit(0)).alias("size")).distinct()
    return slim.withColumn("tail", F.expr(f"size % {capacity}"))


def _planned(tail: DataFrame, capacity: int, rounds: int):
    """Lengths, their numbers and classes, the classes' sizes, the plan and its lower bound."""
    histogram = tail.where(F.col("tail") > 0).groupBy("tail").count().orderBy("tail").collect()  # at most `capacity` rows
    lengths = np.array([r["tail"] for r in histogram], np.int64)
    numbers = np.array([r["count"] for r in histogram], np.int64)
    sizes, index = np.unique(classes(lengths), return_inverse=True)
    totals = np.bincount(index, numbers, len(sizes)).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
    plan, lower = solve(sizes, totals, capacity, rounds) if len(sizes) else ([], 0.0)
    return lengths, numbers, index, sizes, plan, lower


def containers_needed(items: DataFrame, *, item: str, size: str, capacity: int = CAPACITY, rounds: int = ROUNDS) -> tuple[int, float, float]:
    """(containers that `packed` uses, lower bound by the program's dual, lower bound by sizes alone), full pieces included."""
    sized = _sizes(items, item, size, capacity)
    full, volume = sized.agg(F.coalesce(F.sum(F.expr(f"size div {capacity}")), F.lit(0)), F.coalesce(F.sum("tail"), F.lit(0))).first()
    *_, plan, lower = _planned(sized, capacity, rounds)
    return full + sum(n for n, _ in plan), full + lower, full + volume / capacity


def packed(items: DataFrame, *, item: str, size: str, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """(item, piece_no, start, length, container) of all items; an item is cut only if it alone exceeds capacity.

    An item over capacity is cut into pieces that fill a container each, and the rest, which is packed like an item. Items of
    size 0 or null go to container 0 with length 0, which takes no space. Repeated (item, size) rows count once; other
    columns are ignored.
    """
    tail = _sizes(items, item, size, capacity)
    slim = tail.drop("tail")
    lengths, numbers, index, sizes, plan, _ = _planned(tail, capacity, rounds)
    first = np.cumsum([0, *[n for n, _ in plan]])
    # Of each class: the rank its slots in each filling start from, the slots per container, and the first container.
    slots = []
    for k in range(len(sizes)):
        rows = [(int(n * f[k]), int(f[k]), int(first[p])) for p, (n, f) in enumerate(plan) if f[k]]
        ends = np.cumsum([r[0] for r in rows])
        slots.append((np.concatenate(([0], ends[:-1])).astype(np.int64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])))
    class_of = dict(zip(lengths.tolist(), index.tolist()))
    ranked = running_totals(tail.where(F.col("tail") > 0).withColumn("one", F.lit(1)), ["tail"], ["item"], "one", "rank")
    # Ranks run within a length; a class's lengths follow each other.
    base = np.zeros(len(lengths), np.int64)
    for i in range(1, len(lengths)):
        base[i] = base[i - 1] + numbers[i - 1] if index[i] == index[i - 1] else 0
    base_of = dict(zip(lengths.tolist(), base.tolist()))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            container = np.empty(len(batch), np.int64)
            kind = batch["tail"].map(class_of).to_numpy()
            rank = batch["rank"].to_numpy() - 1 + batch["tail"].map(base_of).to_numpy()
            for k in np.unique(kind):
                at = np.flatnonzero(kind == k)
                start, per, begin = slots[k]
                p = np.searchsorted(start, rank[at], side="right") - 1
                container[at] = begin[p] + (rank[at] - start[p]) // per[p]
            yield pd.DataFrame({"item": batch["item"], "piece_no": batch["size"] // capacity, "start": batch["size"] - batch["tail"], "length": batch["tail"], "container": container + 1})

    kind = dict(items.dtypes)[item]
    ends = ranked.mapInPandas(place, f"item {kind}, piece_no bigint, start bigint, length bigint, container bigint")
    # Full pieces have containers of their own, named by negative numbers that no two items share.
    full = slim.where(F.col("size") >= capacity).withColumn("full", F.expr(f"size div {capacity}")).withColumn("one", F.lit(1))
    counted = running_totals(full, [], ["item", "size"], "full", "until")
    full = counted.select("item", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("full") - 1)).alias("piece_no"), "until")
    full = full.select("item", "piece_no", (F.col("piece_no") * capacity).alias("start"), F.lit(capacity).cast("bigint").alias("length"), (F.col("piece_no") - F.col("until")).alias("container"))
    none = slim.where(F.col("size") == 0).select("item", F.lit(0).cast("bigint").alias("piece_no"), F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("length"), F.lit(0).cast("bigint").alias("container"))
    return ends.unionByName(full).unionByName(none)
