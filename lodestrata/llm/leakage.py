"""Held-out test items inside training text: BM25 with block-max WAND over passages, then verification.

The inverted index holds the fields (question, answer) of the test items. Each training text is cut into passages of
PASSAGE words, consecutive ones sharing `run` - 1 words, so any `run` consecutive words lie within one passage; passages
also end at words that no test item has, as a shared run cannot hold one. Each passage is a query. For field d the threshold is the least BM25 score that a passage holding any `run` consecutive words
of d can have: the least sum of term weights over the windows of d. Weights are stored divided by that threshold, so
retrieval is lossless with the threshold 1 for all fields:

* WAND: a passage whose terms' largest weights add up to less than 1 is skipped;
* block-max: fields are kept in blocks of similar text; of a passage's blocks only those whose block-wise largest weights
  add up to 1 or more are opened;
* fields in opened blocks are scored through their postings, and all that reach 1 are retrieved.

Passages of a batch are evaluated together with numpy. Retrieved pairs are verified: they must share `run` words in a row.

The index is broadcast. What counts is its size as built and serialised: items are put into as many hash blocks as keep every
index below BUILT_BYTES, measured, not estimated, and the corpus is searched once for each block.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import words

PASSAGE = 64
BLOCK = 16
K1, B = 1.2, 0.75
SLACK = 1e-4
#: Bytes that one serialised index may have; more items are indexed and searched in several rounds.
BUILT_BYTES = 128 << 20
#: Serialised bytes expected of a byte of item text: decides on how many blocks to begin with.
EXPECTED = 4
#: Fields whose windows a task keeps at hand.
FIELDS_AT_HAND = 4096
#: Words of training text that are searched at once within a task.
AT_ONCE = 200_000

SCHEMA = "item_id bigint, doc string, field string, score double"


def runs(text: np.ndarray, run: int) -> set[bytes]:
    return {text[i : i + run].tobytes() for i in range(len(text) - run + 1)}


class BlockMaxIndex:
    """BM25 postings of test item fields with list-wise and block-wise upper bounds."""

    def __init__(self, fields: list[tuple[int, str, list[str]]], run: int):
        fields = sorted((f for f in fields if len(f[2]) >= run), key=lambda f: (f[2], f[0], f[1]))
        self.run, self.owner = run, [(i, name) for i, name, _ in fields]
        vocabulary: dict[str, int] = {}
        texts = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in ws], np.int32) for _, _, ws in fields]
        self.vocabulary = vocabulary
        n, v = len(fields), len(vocabulary)
        self.texts = texts
        self._windows: dict[int, set[bytes]] = {}
        frequency = Counter(int(w) for t in texts for w in set(t.tolist()))
        mean = sum(map(len, texts)) / max(1, n)
        terms, docs, weights = [], [], []
        for d, t in enumerate(texts):
            weight = {}
            for w, tf in Counter(t.tolist()).items():
                idf = math.log(1 + (n - frequency[w] + 0.5) / (frequency[w] + 0.5))
                weight[w] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(t) / mean))
            least = min(sum(weight[w] for w in set(t[i : i + run].tolist())) for i in range(len(t) - run + 1))
            for w, x in weight.items():
                terms.append(w)
                docs.append(d)
                weights.append(x / least)
        order = np.lexsort((docs, terms)) if terms else np.zeros(0, np.int64)
        self.docs = np.array(docs, np.int32)[order]
        self.weights = np.array(weights, np.float32)[order]
        terms_sorted = np.array(terms, np.int64)[order]
        self.blocks = -(-n // BLOCK)
        # (term, block) cells in order, with their first posting and their largest weight.
        cells = terms_sorted * max(1, self.blocks) + self.docs // BLOCK
        self.cell, self.cell_start = np.unique(cells, return_index=True)
        self.cell_end = np.append(self.cell_start[1:], len(cells))
        self.cell_max = np.maximum.reduceat(self.weights, self.cell_start) if len(cells) else np.zeros(0)
        self.term_start = np.searchsorted(self.cell, np.arange(v + 1) * max(1, self.blocks))
        self.term_max = np.array([self.cell_max[a:b].max() for a, b in zip(self.term_start[:-1], self.term_start[1:])]) if v else np.zeros(0)

    def windows(self, d: int) -> set[bytes]:
        """All runs of words of a field, made when a passage first asks for them."""
        found = self._windows.get(d)
        if found is None:
            if len(self._windows) >= FIELDS_AT_HAND:
                self._windows.clear()
            found = self._windows[d] = runs(self.texts[d], self.run)
        return found

    @staticmethod
    def _spread(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All positions of the ranges, and for each the number of its range."""
        size = end - start
        which = np.repeat(np.arange(len(start)), size)
        return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + start[which], which

    def retrieve(self, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of queries, given as distinct pairs (passage, term) in order: all (passage, field, score) with score >= 1."""
        reach = np.zeros(passage.max() + 1 if len(passage) else 0)
        np.add.at(reach, passage, self.term_max[term])
        alive = reach[passage] >= 1 - SLACK
        passage, term = passage[alive], term[alive]
        cell, of = self._spread(self.term_start[term], self.term_start[term + 1])
        key = passage[of] * self.blocks + self.cell[cell] % max(1, self.blocks)
        order = np.argsort(key, kind="stable")
        key, cell = key[order], cell[order]
        if not len(key):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        _, first, size = np.unique(key, return_index=True, return_counts=True)
        opened = np.repeat(np.add.reduceat(self.cell_max[cell], first) >= 1 - SLACK, size)
        key, cell = key[opened], cell[opened]
        posting, of = self._spread(self.cell_start[cell], self.cell_end[cell])
        pair = (key[of] // self.blocks) * len(self.owner) + self.docs[posting]
        pair, inverse = np.unique(pair, return_inverse=True)
        score = np.bincount(inverse, self.weights[posting], len(pair))
        hit = score >= 1 - SLACK
        return pair[hit] // len(self.owner), pair[hit] % len(self.owner), score[hit]

    def search(self, texts: list[list[str]]) -> Iterator[tuple[int, int, float]]:
        """(text, field, best score) of the verified pairs, each once."""
        run, step = self.run, PASSAGE - self.run + 1
        if not self.owner:
            return
        get = self.vocabulary.get
        flat = np.array([i for ws in texts for i in (*[get(w, -1) for w in ws], -1)], np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(ws) + 1 for ws in texts])
        # Stretches of words that occur in the index; a word that doesn't cannot lie within a shared run.
        edge = np.diff(np.concatenate(([0], flat >= 0, [0])))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = end - begin >= run
        spans = [(s, min(s + PASSAGE, e)) for b, e in zip(begin[long].tolist(), end[long].tolist()) for s in range(b, max(b + 1, e - run + 1), step)]
        if not spans:
            return
        starts = [(int(owner[s]), s) for s, _ in spans]
        parts = [flat[s:e] for s, e in spans]
        number = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        pairs = np.unique(number * len(self.vocabulary) + np.concatenate(parts))
        best: dict[tuple[int, int], float] = {}
        windows: tuple[int, set[bytes]] = (-1, set())
        for p, d, score in zip(*map(np.ndarray.tolist, self.retrieve(pairs // len(self.vocabulary), pairs % len(self.vocabulary)))):
            if p != windows[0]:
                windows = (p, runs(parts[p].astype(np.int32), run))
            if not windows[1].isdisjoint(self.windows(d)):
                best[starts[p][0], d] = max(score, best.get((starts[p][0], d), 0.0))
        for (t, d), score in best.items():
            yield t, d, score


def leaked_items(corpus: DataFrame, items: DataFrame, *, doc: str, text: str, item: str = "item_id", fields: tuple[str, ...] = ("question", "answer"), run: int = 12, built_bytes: int = BUILT_BYTES) -> DataFrame:
    """One row (item_id, doc, field, score) for each item field of which doc's text holds `run` consecutive words.

    score is the passage's BM25 score relative to the field's threshold. Null texts and fields, and fields or texts of fewer
    than `run` words, give nothing; rows delivered twice give their pairs once; other columns are ignored. Rows whose item or
    doc is null are left out. If their index exceeds built_bytes, they are searched in rounds of hash blocks.
    """
    spark = corpus.sparkSession
    slim = items.select(F.col(item).cast("bigint").alias("_item"), *[F.col(f).alias(f) for f in fields]).where(F.col("_item").isNotNull()).distinct()
    size = slim.agg(F.sum(sum(F.coalesce(F.octet_length(f), F.lit(0)) for f in fields))).first()[0] or 0
    rounds = max(1, -(-int(size) * EXPECTED // built_bytes))
    source = corpus.select(F.col(doc).cast("string").alias("doc"), F.col(text).alias("text")).where(F.col("text").isNotNull() & F.col("doc").isNotNull())
    found, k = None, 0
    while k < rounds:
        block = slim if rounds == 1 else slim.where(F.pmod(F.xxhash64("_item"), F.lit(rounds)) == k)
        rows = block.collect()  # built_bytes / EXPECTED of text, about
        built = BlockMaxIndex([(r["_item"], f, words(r[f])) for r in rows for f in fields], run)
        if len(rows) > 1 and len(pickle.dumps(built, pickle.HIGHEST_PROTOCOL)) > built_bytes:
            found, k, rounds = None, 0, rounds * 2
            continue
        k += 1
        index = spark.sparkContext.broadcast(built)

        def search(batches: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            def flush(docs: list[str], texts: list[list[str]]) -> pd.DataFrame:
                owner = index.value.owner
                return pd.DataFrame([(owner[d][0], docs[t], owner[d][1], s) for t, d, s in index.value.search(texts)], columns=["item_id", "doc", "field", "score"])

            for batch in batches:
                docs, texts, held = [], [], 0
                for name, body in zip(batch["doc"], batch["text"]):
                    docs.append(name)
                    texts.append(words(body))
                    held += len(texts[-1])
                    if held >= AT_ONCE:
                        yield flush(docs, texts)
                        docs, texts, held = [], [], 0
                if docs:
                    yield flush(docs, texts)

        part = source.mapInPandas(search, SCHEMA)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("item_id", "doc", "field").agg(F.max("score").alias("score"))
