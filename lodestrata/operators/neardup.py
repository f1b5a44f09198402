"""Near-duplicate texts: classes linked by a Jaccard similarity of at least 0.8 over shingles of five words, verified exactly.

Texts of the same shingles are one node, told by a 64-bit hash of the sorted set. A node of n shingles can reach 0.8 only with
nodes that share one of its first n // 5 + 1 shingles, in any order that all nodes agree on (prefix filter), so no link is
lost. The order puts rare shingles first: by the counts of BUCKETS hash buckets, a table of fixed size that is broadcast, then by
hash. Sizes and positions rule out further pairs that cannot reach 0.8; the rest are compared shingle by shingle. Classes are the
connected components of the links. Shingles are compared as 64-bit hashes.

The flag of 9 bands of 13 minima is kept beside it (`shares_band`); alone it misses most pairs near 0.8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..runtime import cut, skew_safe_lookup

WORDS, BANDS, ROWS = 5, 9, 13
#: The largest prime below 2 ** 32.
PRIME = 4294967291
#: Counts that order the shingles; more texts than fit only make the order less sharp.
BUCKETS = 1 << 20
#: Longer lists of nodes with the same shingle are joined in parts of about this many.
LIST = 1000


def shingles(docs: DataFrame, *, id: str, text: str) -> DataFrame:
    """(id, s) with a 64-bit hash of each distinct five-word shingle, or of the whole text if it is shorter."""
    return shingle_sets(docs, id=id, text=text).select("id", F.explode_outer("set").alias("s"))


def shingle_sets(docs: DataFrame, *, id: str, text: str) -> DataFrame:
    """(id, set) of the texts that have words, each with the hashes of its distinct shingles in ascending order.

    Explode sets with explode_outer: explode infers a filter that is pushed down and splits the text again for each shingle.
    """
    w = X.words(F.lower(F.col(text)))
    rows = docs.select(F.col(id).alias("id"), w.alias("w")).where(F.size("w") > 0)
    many = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - WORDS + 1, F.lit(1))), lambda i: F.xxhash64(F.array_join(F.slice("w", i, WORDS), " ")))
    return rows.select("id", F.sort_array(F.array_distinct(many)).alias("set"))


def band_keys(docs: DataFrame, *, id: str, text: str) -> DataFrame:
    """(id, band, key): BANDS keys of ROWS minima each. The minima are partial aggregates of the shingle rows."""
    rows = shingles(docs, id=id, text=text)
    minima = rows.groupBy("id").agg(*[F.min(F.xxhash64(F.lit(i), "s")).alias(f"m{i}") for i in range(BANDS * ROWS)])
    keys = [F.struct(F.lit(b).alias("band"), F.xxhash64(*[f"m{b * ROWS + r}" for r in range(ROWS)]).alias("key")) for b in range(BANDS)]
    return minima.select("id", F.explode(F.array(*keys)).alias("k")).select("id", "k.band", "k.key")


def minhash(docs: DataFrame, *, id: str, text: str = "text", permutations: int = 128) -> DataFrame:
    """(id, signature): digest of the minima of linear permutations (h * a + b) mod a prime of the shingles' 32-bit hashes.

    Computed within a text's row by expressions, so no shingle is shuffled. Blank texts have none.
    """
    w = X.words(F.lower(F.col(text)))
    rows = docs.select(F.col(id).alias("id"), w.alias("w")).where(F.size("w") > 0)
    one = lambda i: F.conv(F.substring(F.md5(F.array_join(F.slice("w", i, WORDS), " ")), 1, 8), 16, 10).cast("bigint")
    hashes = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - WORDS + 1, F.lit(1))), one))
    rows = rows.select("id", F.explode(F.array(hashes)).alias("h"))
    least = lambda p: F.array_min(F.transform("h", lambda h: (h * ((p + 1) * F.lit(1000003) % F.lit(2147483647)) + p * F.lit(7919)) % F.lit(PRIME)))
    minima = F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(permutations - 1).cast("bigint")), least)
    return rows.select(F.col("id").alias(id), F.md5(F.array_join(minima.cast("array<string>"), ",")).alias("signature"))


def prefixes(sets: DataFrame) -> DataFrame:
    """(node, n, s, pos) of each distinct node's first n // 5 + 1 shingles, rare ones first."""
    bucket = F.col("s").bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("bucket")
    counted = sets.select(F.explode_outer("set").alias("s")).groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).toPandas()  # BUCKETS rows at most
    counts = np.zeros(BUCKETS, dtype=np.int64)
    counts[counted["bucket"].to_numpy(dtype=np.int64)] = counted["n"]
    shared = sets.sparkSession.sparkContext.broadcast(counts)

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes, parts = [], []
            for node, s in zip(batch["node"], batch["set"]):
                s = np.asarray(s, dtype=np.int64)
                parts.append((len(s), s[np.lexsort((s, shared.value[s & (BUCKETS - 1)]))[: len(s) // 5 + 1]]))
                nodes.append(node)
            lengths = [len(s) for _, s in parts]
            yield pd.DataFrame({"node": np.repeat(np.array(nodes, dtype=np.int64), lengths), "n": np.repeat(np.array([n for n, _ in parts], dtype=np.int64), lengths), "s": np.concatenate([np.empty(0, np.int64), *[s for _, s in parts]]), "pos": np.concatenate([np.empty(0, np.int64), *[np.arange(k) for k in lengths]])})

    return sets.select("node", "set").mapInPandas(first, "node bigint, n bigint, s bigint, pos bigint").distinct()


def candidates(rows: DataFrame) -> DataFrame:
    """(a, b) of the nodes, a < b, whose prefixes, sizes and positions allow a similarity of 0.8."""
    lists = rows.groupBy("s").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > 1).select("s", F.ceil(F.col("k") / LIST).cast("int").alias("k"))
    rows = cut(rows.join(lists, "s"))
    a = rows.select("s", F.pmod(F.xxhash64("node"), F.col("k")).cast("int").alias("part"), F.col("node").alias("a"), F.col("n").alias("na"), F.col("pos").alias("i"))
    b = rows.select("s", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("part"), F.col("node").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("j"))
    pairs = a.join(b, ["s", "part"]).where((F.col("a") < F.col("b")) & (5 * F.least("na", "nb") >= 4 * F.greatest("na", "nb")))
    # All that both share up to the last shingle that their prefixes share is counted; behind it they share what is left at most.
    pairs = pairs.groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("c"), F.max("i").alias("i"), F.max("j").alias("j"))
    return pairs.where(9 * (F.col("c") + F.least(F.col("na") - 1 - F.col("i"), F.col("nb") - 1 - F.col("j"))) >= 4 * (F.col("na") + F.col("nb"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of the nodes of links (a, b); label is the smallest node of the component. Alternating large and small stars."""
    edges, state = cut(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = cut(both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def links(docs: DataFrame, nodes: DataFrame, sets: DataFrame, *, id: str, text: str) -> DataFrame:
    """(a, b) of all pairs of nodes with a similarity of at least 0.8; nodes has (id, node)."""
    pairs = cut(candidates(prefixes(sets)))
    asked = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    ones = nodes.groupBy("node").agg(F.min("id").alias("id")).join(asked, "node")
    some = docs.join(ones.select(F.col("id").alias(id)), id, "left_semi")
    some = cut(shingle_sets(some, id=id, text=text).select(F.xxhash64("set").alias("node"), "set").join(asked, "node", "left_semi").dropDuplicates(["node"]))
    side = lambda x: some.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where(9 * F.size(F.array_intersect("set_a", "set_b")) >= 4 * (F.size("set_a") + F.size("set_b"))).select("a", "b")


def near_dup_status(docs: DataFrame, *, id: str, text: str = "text") -> DataFrame:
    """(id, status, class_id, shares_band), one row per document.

    class_id is the smallest id of the document's class, status near_dup if the class has another document, else unique;
    every member is flagged, none is kept. shares_band: another text shares one of 9 bands of 13 minima, which at similarity
    0.8 happens with probability 0.40, at 0.9 with 0.93. Members are told by band counts, so no pair is formed for it. Blank
    texts are unique.
    """
    keys = cut(band_keys(docs, id=id, text=text))
    shared = keys.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("one")).where(F.col("n") > 1)
    flagged = keys.join(shared.select("band", "key"), ["band", "key"], "left_semi").select("id").distinct().withColumn("dup", F.lit(True))
    sets = shingle_sets(docs, id=id, text=text).withColumn("node", F.xxhash64("set"))
    nodes = cut(sets.select("id", "node").distinct())
    labels = components(links(docs, nodes, sets, id=id, text=text))
    sizes = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("one"))
    classes = cut(sizes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    whole = classes.groupBy("label").agg(F.sum("n").alias("size"), F.min("one").alias("class_id"))
    found = cut(classes.join(whole, "label").select("node", "n", "size", "class_id"))
    member = skew_safe_lookup(nodes, found, ["node"], "n", nodes.count()).groupBy("id").agg(F.min("class_id").alias("class_id"), F.max("size").alias("size"))
    all_ids = docs.select(F.col(id).alias("id")).distinct()
    rows = all_ids.join(member, "id", "left").join(flagged, "id", "left")
    return rows.select(F.col("id").alias(id), F.when(F.col("size") > 1, "near_dup").otherwise("unique").alias("status"), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("dup", F.lit(False)).alias("shares_band"))
