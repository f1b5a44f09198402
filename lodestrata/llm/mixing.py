"""Sources mixed to target weights: temperature mixing with a repetition limit, realised as budgeted block permutations.

Shares are tempered geometrically between what the sources hold and what is wanted: share_i(b) is proportional to
held_i * (wanted_i / held_i) ** b, the natural mix at b = 0 and the wanted one at b = 1. The exponent b is bisected between
these to the repetition limit, or to a target entropy, and the normalised shares are the budgets. A source that falls short of its
target even at its limit gives all it may; the others share the rest of the total size by the tempered shares, so the total
is kept as long as the limits allow it. Without sources at their limit b is 1 and every budget is its target.

Budgets are realised as permutations: each pass over a source puts its documents into an order of its own by hash, and takes
them until the budget is used up. The copies of all sources are dealt into blocks of BLOCK tokens by how much of their
source's budget lies before them, so every block holds the sources in their shares, and are permuted within the block by
hash. Running sizes come from range-partitioned sorts with partition offsets, so no source is gathered into one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut, running_totals

#: Up to this many targets the driver adds up the shares itself, beyond them each step of the bisection is a query.
MOST_SOURCES = 100_000
#: Tokens of a block of the mixture.
BLOCK = 1 << 20
STEPS = 60


def tempered_shares(held: dict[str, float], wanted: dict[str, float], b: float) -> dict[str, float]:
    """Shares at exponent b; sources that hold nothing or are not wanted get none."""
    weight = {s: held[s] ** (1 - b) * wanted[s] ** b for s in wanted if held.get(s, 0) > 0 and wanted[s] > 0}
    total = sum(weight.values())
    return {s: weight.get(s, 0.0) / total if total else 0.0 for s in wanted}


def entropy(shares: dict[str, float]) -> float:
    return -sum(x * math.log(x) for x in shares.values() if x > 0)


def bisect(good: Callable[[float], bool]) -> float:
    """1 if that is good, else the end of a stretch of good values from 0, to the last bit."""
    if good(1.0):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (middle, high) if good(middle) else (low, middle)
    return low


def bisect_exponent(held: dict[str, float], wanted: dict[str, float], limit: dict[str, float], total: float, target_entropy: float | None = None) -> float:
    """The b at which share * total stays within limit for all sources; with target_entropy, the b whose shares have it, if
    that is within reach."""

    def good(b: float) -> bool:
        shares = tempered_shares(held, wanted, b)
        if target_entropy is not None:
            rising = entropy(tempered_shares(held, wanted, 1.0)) >= entropy(tempered_shares(held, wanted, 0.0))
            return (entropy(shares) <= target_entropy) == rising
        return all(shares[s] * total <= limit[s] * (1 + 1e-12) for s in shares)

    return bisect(good)


class _Local:
    """The sources as arrays on the driver."""

    def __init__(self, rows: DataFrame):
        frame = rows.toPandas()  # MOST_SOURCES rows at most
        self.source = frame["source"].tolist()
        self.held, self.wanted, self.limit = (frame[c].to_numpy(float) for c in ("held", "target_share", "most"))
        self.free = (self.held > 0) & (self.wanted > 0) & (self.limit > 0)
        self.pinned = ~self.free

    def pin(self, total: float, b: float | None) -> int:
        """Gives those over their limit all they may; how many these are. Without b their own targets count, else the shares."""
        asked = self.wanted * total if b is None else self.shares(b) * self.rest(total)
        over = self.free & (self.limit < asked * (1 - 1e-12))
        self.free &= ~over
        self.pinned |= over
        return int(over.sum())

    def rest(self, total: float) -> float:
        return max(0.0, total - self.limit[self.pinned].sum())

    def shares(self, b: float) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            weight = np.where(self.free, self.held ** (1 - b) * self.wanted**b, 0.0)
        return weight / weight.sum() if weight.sum() else weight

    def within(self, total: float, b: float) -> bool:
        return bool((self.shares(b) * self.rest(total) <= self.limit * (1 + 1e-12))[self.free].all())

    def entropy(self, b: float) -> float:
        x = self.shares(b)
        return float(-(x[x > 0] * np.log(x[x > 0])).sum())

    def frame(self, rows: DataFrame, total: float, b: float) -> DataFrame:
        shares = self.shares(b)
        budget = np.where(self.pinned, self.limit, shares * self.rest(total))
        made = rows.sparkSession.createDataFrame(list(zip(self.source, map(float, shares), map(float, budget))), "source string, tempered_share double, budget double")
        return rows.join(made, "source")


class _Spread:
    """The same with one query a step, for more targets than the driver should hold."""

    def __init__(self, rows: DataFrame):
        self.rows = cut(rows.withColumn("free", (F.col("held") > 0) & (F.col("target_share") > 0) & (F.col("most") > 0)))

    def _weight(self, b: float):
        return F.when(F.col("free"), F.pow("held", F.lit(1 - b)) * F.pow("target_share", F.lit(b))).otherwise(F.lit(0.0))

    def _sum(self, *columns):
        return [x or 0.0 for x in self.rows.agg(*columns).first()]

    def rest(self, total: float) -> float:
        return max(0.0, total - self._sum(F.sum(F.when(~F.col("free"), F.col("most").cast("double"))))[0])

    def pin(self, total: float, b: float | None) -> int:
        asked = F.col("target_share") * total if b is None else self._weight(b) * (self.rest(total) / (self._sum(F.sum(self._weight(b)))[0] or 1.0))
        over = F.col("free") & (F.col("most") < asked * (1 - 1e-12))
        n = int(self._sum(F.count_if(over))[0])
        if n:
            self.rows = cut(self.rows.withColumn("free", F.col("free") & ~over))
        return n

    def within(self, total: float, b: float) -> bool:
        whole, worst = self._sum(F.sum(self._weight(b)), F.max(self._weight(b) / F.when(F.col("most") > 0, F.col("most"))))
        return not whole or worst * self.rest(total) / whole <= 1 + 1e-12

    def entropy(self, b: float) -> float:
        w = self._weight(b)
        whole, logs = self._sum(F.sum(w), F.sum(F.when(w > 0, w * F.log(w))))
        return math.log(whole) - logs / whole if whole else 0.0

    def frame(self, rows: DataFrame, total: float, b: float) -> DataFrame:
        whole, rest = self._sum(F.sum(self._weight(b)))[0], self.rest(total)
        share = self._weight(b) / F.lit(whole or 1.0)
        return self.rows.select(*rows.columns, share.alias("tempered_share"), F.when(F.col("free"), share * rest).otherwise(F.col("most").cast("double")).alias("budget"))


def mixture_plan(documents: DataFrame, targets: DataFrame, *, source: str = "source", text: str = "text", target_entropy: float | None = None, most_local: int = MOST_SOURCES) -> DataFrame:
    """One row per wanted source: source, target_share, max_repeats, docs, held, total, exponent, tempered_share, budget, repeats,
    actual_share, falls_short.

    Sizes are UTF-8 bytes. total is the size of all documents. falls_short: held * max_repeats < target_share * total; such a
    source gets its limit held * max_repeats as budget, the others tempered_share of the rest (tempered_share is 0 for those at their
    limit). Sources that the tempered shares would take over their limit at every exponent are pinned to it as well. Budgets are whole
    bytes, repeats = budget / held (1: used once), actual_share = budget / sum of budgets. With target_entropy the exponent is bisected to
    that entropy of the free sources' shares, and pinned sources follow from the limits. Source names are compared as they are;
    null texts have size 0, a null max_repeats counts as 1 and a null target_share as 0. Repeated target rows count once, of
    differing ones for a source the largest; without documents all budgets are 0.
    """
    sized = documents.select(F.col(source).alias("source"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("size"))
    sums = sized.groupBy("source").agg(F.sum("size").alias("held"), F.count(F.lit(1)).alias("docs"))
    wanted = targets.where(F.col(source).isNotNull()).groupBy(F.col(source).alias("source")).agg(F.coalesce(F.max("target_share"), F.lit(0.0)).alias("target_share"), F.coalesce(F.max("max_repeats"), F.lit(1)).alias("max_repeats"))
    whole = sums.agg(F.coalesce(F.sum("held"), F.lit(0)).alias("total"))
    rows = wanted.join(sums, "source", "left").crossJoin(F.broadcast(whole))
    rows = cut(rows.select("source", "target_share", "max_repeats", F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce("held", F.lit(0)).alias("held"), "total", (F.coalesce("held", F.lit(0)) * F.col("max_repeats")).alias("most")))
    n, total = rows.agg(F.count(F.lit(1)), F.max("total")).first()
    total = float(total or 0)
    mix = _Local(rows) if n <= most_local else _Spread(rows)
    mix.pin(total, None)
    while True:
        if target_entropy is not None:
            rising = mix.entropy(1.0) >= mix.entropy(0.0)
            b = bisect(lambda x: (mix.entropy(x) <= target_entropy) == rising)
        elif mix.within(total, 1.0) or mix.within(total, 0.0):
            b = bisect(lambda x: mix.within(total, x))
        else:
            b = 1.0
        if not mix.pin(total, b):
            break
    plan = mix.frame(rows, total, b).withColumn("budget", F.floor("budget").cast("bigint"))
    realised = plan.agg(F.sum("budget").alias("realised"))
    plan = plan.crossJoin(F.broadcast(realised))
    return plan.select(
        "source", "target_share", "max_repeats", "docs", "held", "total", F.lit(b).alias("exponent"), "tempered_share", "budget", F.coalesce(F.try_divide("budget", "held"), F.lit(0.0)).alias("repeats"),
        F.coalesce(F.try_divide("budget", "realised"), F.lit(0.0)).alias("actual_share"), (F.col("most") < F.col("target_share") * F.col("total")).alias("falls_short"),
    )


def mixed_documents(documents: DataFrame, plan: DataFrame, *, id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0, block: int = BLOCK) -> DataFrame:
    """(id, source, size, pass_no, block_no, position) of every copy of a document in the mixture; position counts from 1.

    Pass k over a source takes its documents in the order of a hash of seed, k and id; the last pass ends with the document
    in which the budget does, so a source exceeds its budget by less than one document, and a source at its limit is taken whole
    exactly. A copy belongs to the block in which its share of its source's budget falls, and has a hashed place within it. Repeated
    (id, source) rows count once; documents without text take no space and are left out.
    """
    slim = documents.select(F.col(id).alias("id"), F.col(source).alias("source"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("size"))
    slim = slim.where(F.col("size") > 0).dropDuplicates(["id", "source"]).join(plan.select("source", "held", "budget").where(F.col("budget") > 0), "source")
    passes = slim.withColumn("pass_no", F.explode(F.sequence(F.lit(0), F.ceil(F.col("budget") / F.col("held")).cast("int") - 1)))
    hashed = lambda what: F.md5(F.concat_ws("|", F.lit(what), F.lit(seed), "pass_no", "id"))
    run = running_totals(passes.withColumn("h", hashed("order")), ["source", "pass_no"], ["h", "id"], "size", "until")
    before = F.col("pass_no") * F.col("held") + F.col("until") - F.col("size")
    taken = run.withColumn("before", before).where(F.col("before") < F.col("budget"))
    blocks = F.greatest(F.lit(1), F.ceil(plan.agg(F.sum("budget").alias("b")).first()["b"] / F.lit(float(block)))) if plan.take(1) else F.lit(1)
    taken = taken.withColumn("block_no", F.floor(F.col("before") / F.col("budget") * blocks).cast("bigint")).withColumn("h", hashed("block")).withColumn("one", F.lit(1))
    placed = running_totals(taken, [], ["block_no", "h", "source", "id"], "one", "position")
    return placed.select("id", "source", "size", F.col("pass_no").cast("int").alias("pass_no"), "block_no", "position")
