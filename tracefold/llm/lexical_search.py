"""Ranked lexical search with per-term geometric blocks, in shards of documents.

A first pass over the documents keeps, for each, its length and its frequencies of the terms that any item
asks for, and gives the corpus statistics. A shard is some hundred thousand of these postings, held by one
task. For every term an item visits there, the term's posting list is clustered: representatives are spread
over the list, each document goes to the one it is most similar to (by a signed projection of its weights),
and clusters are cut into blocks. A block stores the coordinatewise maximum of its documents' weights, so the
product of an item with it is an exact upper bound of its documents' scores, in whole numbers.

An item visits its terms by falling bounds. It skips a block only if the bound is below the score of the
shard's tenth document so far, and ends when the bounds of the remaining terms together are below it: a
document that was not seen holds only those terms. The best of all shards are merged by Spark.

Items go to the tasks in blocks of about ``block_bytes`` of text, each with its own pass over the documents.

Defined cases: a null or empty text has no terms, is not counted and not found; an item without terms finds
nothing. Repeated items are ranked each on their own. Equal scores are ordered by key, nulls last, then in any
order of the rows. Only scores above zero are listed.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracefold.llm.common import written
from tracefold.llm.decontamination import words_of

SCALE = 10**9
HELD = 1 << 23  # maxima of a shard's blocks that are kept for the next items


def term_weight(documents: int, holding: int) -> int:
    """The weight of a term by the documents that hold it."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Shard:
    """Documents as rows of whole weights by term, with blocks for the posting lists that items visit."""

    def __init__(self, ends: np.ndarray, terms: np.ndarray, weights: np.ndarray, order: np.ndarray, n_terms: int, block: int = 32):
        self.ends, self.terms, self.weights = ends, terms, weights
        self.starts = np.append(0, ends[:-1])
        self.order, self.block, self.n_terms = order, block, n_terms
        docs = np.repeat(np.arange(len(ends)), ends - self.starts)
        # posting lists, a term after the other
        by_term = np.argsort(terms, kind="stable")
        self.listed = docs[by_term]
        self.list_ends = np.cumsum(np.bincount(terms, minlength=n_terms))
        self.most = np.zeros(n_terms, np.int64)
        np.maximum.at(self.most, terms, weights)
        self.directions = self._directions(docs)
        self.blocks: dict[int, tuple] = {}

    def _directions(self, docs: np.ndarray, size: int = 24) -> np.ndarray:
        """Documents as short vectors of length one; similar weights give similar directions."""
        signs = np.random.default_rng(17).choice(np.array([-1, 1], np.float32), (self.n_terms, size))
        out = np.empty((len(self.ends), size), np.float32)
        scaled = self.weights.astype(np.float32)
        for k in range(size):
            out[:, k] = np.bincount(docs, scaled * signs[self.terms, k], len(self.ends))
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def _rows(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the documents' entries, and the sizes of the rows."""
        sizes = self.ends[docs] - self.starts[docs]
        total = np.cumsum(sizes)
        return np.arange(total[-1] if len(total) else 0) + np.repeat(self.starts[docs] - (total - sizes), sizes), sizes

    def blocks_of(self, term: int) -> tuple:
        """The blocks of a term's list: documents, ends of blocks, and the maxima as (term * blocks + block, weight)."""
        if term not in self.blocks:
            # lists are clustered anew when others took their place
            if sum(len(keys) for _, _, keys, _ in self.blocks.values()) > HELD:
                self.blocks.clear()
            self.blocks[term] = self._cluster(self.listed[self.list_ends[term - 1] if term else 0:self.list_ends[term]])
        return self.blocks[term]

    def _cluster(self, docs: np.ndarray) -> tuple:
        wanted = -(-len(docs) // self.block)
        if wanted > 1:
            heads = docs[np.arange(wanted) * len(docs) // wanted]
            nearest = np.concatenate([
                (self.directions[docs[k:k + 4096]] @ self.directions[heads].T).argmax(axis=1) for k in range(0, len(docs), 4096)])
            by_head = np.argsort(nearest, kind="stable")
            docs, nearest = docs[by_head], nearest[by_head]
        else:
            nearest = np.zeros(len(docs), np.int64)
        # clusters are cut into blocks of one size at most
        new = np.append(True, nearest[1:] != nearest[:-1])
        within = np.arange(len(docs)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        starts = np.flatnonzero(within % (2 * self.block) == 0)
        number = np.cumsum(within % (2 * self.block) == 0) - 1
        at, sizes = self._rows(docs)
        keys = self.terms[at].astype(np.int64) * len(starts) + np.repeat(number, sizes)
        by_key = np.argsort(keys, kind="stable")
        keys, weights = keys[by_key], self.weights[at][by_key]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return docs, np.append(starts[1:], len(docs)), keys[first], np.maximum.reduceat(weights, first)

    def bounds(self, blocks: tuple, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Per block the product of the item with its maxima."""
        _, ends, keys, maxima = blocks
        n = len(ends)
        lows, highs = np.searchsorted(keys, terms * n), np.searchsorted(keys, terms * n + n)
        sizes = highs - lows
        total = np.cumsum(sizes)
        at = np.arange(total[-1]) + np.repeat(lows - (total - sizes), sizes)
        out = np.zeros(n, np.int64)
        np.add.at(out, keys[at] % n, maxima[at] * np.repeat(times, sizes))
        return out

    def search(self, terms: np.ndarray, times: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the best ``limit`` for an item of distinct ``terms``, each with its number of repeats."""
        held = self.most[terms] > 0
        terms, times = terms[held], times[held]
        most = self.most[terms] * times
        by_bound = np.argsort(-most, kind="stable")
        # what the terms from each on can add at the most
        left = np.append(np.cumsum(most[by_bound][::-1])[::-1], 0)
        asked = np.zeros(self.n_terms, np.int64)
        asked[terms] = times
        seen = np.zeros(len(self.ends), bool)
        found, scores, floor = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
        for place, term in enumerate(terms[by_bound].tolist()):
            if left[place] < floor:
                break
            blocks = self.blocks_of(term)
            bounds = self.bounds(blocks, terms, times)
            queue = np.argsort(-bounds, kind="stable")
            step, at = 4, 0
            while at < len(queue) and bounds[queue[at]] >= floor:
                taken = queue[at:at + step]
                taken = taken[bounds[taken] >= floor]
                docs = self._fresh(blocks, taken, seen)
                if len(docs):
                    seen[docs] = True
                    rows, sizes = self._rows(docs)
                    new = np.add.reduceat(self.weights[rows] * asked[self.terms[rows]], np.cumsum(sizes) - sizes)
                    found, scores = np.append(found, docs), np.append(scores, new)
                    if len(scores) >= limit:
                        floor = max(1, int(np.partition(scores, -limit)[-limit]))
                    kept = scores >= floor
                    found, scores = found[kept], scores[kept]
                at, step = at + step, step * 2
        best = np.lexsort((self.order[found], -scores))[:limit]
        return found[best], scores[best]

    @staticmethod
    def _fresh(blocks: tuple, taken: np.ndarray, seen: np.ndarray) -> np.ndarray:
        docs, ends, _, _ = blocks
        starts = np.append(0, ends[:-1])[taken]
        sizes = ends[taken] - starts
        total = np.cumsum(sizes)
        listed = docs[np.arange(total[-1]) + np.repeat(starts - (total - sizes), sizes)]
        return listed[~seen[listed]]


def _item_blocks(items: DataFrame, key: str, text: str, block_bytes: int) -> Iterator[DataFrame]:
    rows = items.select(F.col(key).alias("item"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    blocks = 1 + size // block_bytes
    for block in range(blocks):
        yield rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else rows


def forward_rows(docs: DataFrame, terms, key: str, text: str) -> DataFrame:
    """key, n (terms with repeats) and, of the broadcast ``terms``, those that the document holds with their frequencies.

    Documents without a term are left out; the statistics do not count them.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: k for k, t in enumerate(terms.value)}
        for batch in batches:
            take, lengths, ends, held, times = [], [], [0], [], []
            for k, value in enumerate(batch["text"]):
                words = words_of(value.as_py())
                if not words:
                    continue
                found = Counter(filter(number.__contains__, words))
                take.append(k)
                lengths.append(len(words))
                held += map(number.__getitem__, found)
                times += found.values()
                ends.append(len(held))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["key"].take(pa.array(take, pa.int64())), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(held, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))],
                ["key", "n", "terms", "times"])

    kind = rows.schema["key"].dataType.simpleString()
    return written(rows.mapInArrow(count, f"key {kind}, n long, terms array<int>, times array<int>"), "forward")


def rank(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", *,
         limit: int = 10, percent: int = 75, block_bytes: int = 4 << 20, shard_postings: int = 1 << 20, block: int = 32) -> DataFrame:
    """item, rank, key and score of the best ``limit`` documents for each row of ``items``.

    ``percent`` is the share of a document's length in its damping, ``block`` the documents of a block.
    """
    parts = [_rank_block(docs, part, key, text, limit, percent, shard_postings, block)
             for part in _item_blocks(items, item_key, item_text, block_bytes)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.select(F.col("item").alias(item_key), "rank", F.col("key").alias(key), "score")


def _rank_block(docs: DataFrame, items: DataFrame, key: str, text: str, limit: int, percent: int, shard_postings: int, block: int) -> DataFrame:
    spark = docs.sparkSession
    # rows of about block_bytes
    asked = items.toArrow()
    queries = [Counter(words_of(t)) for t in asked["text"].to_pylist()]
    listed = sorted(set().union(*queries))
    rows = forward_rows(docs, spark.sparkContext.broadcast(listed), key, text)
    documents, words = rows.agg(F.count("*"), F.sum("n")).first()
    # a row for each term of the block
    held = {r.term: r.n for r in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).toLocalIterator()}
    weights = np.array([term_weight(documents, held.get(k, 0)) for k in range(len(listed))], np.int64)
    number = {t: k for k, t in enumerate(listed)}
    wanted = [(np.array([number[t] for t in q], np.int64), np.array(list(q.values()), np.int64)) for q in queries]
    shared = spark.sparkContext.broadcast((weights, wanted))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, wanted = shared.value
        waiting, postings = [], 0
        for batch in batches:
            sizes = np.cumsum(pc.list_value_length(batch["terms"]).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < batch.num_rows:
                before = sizes[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(sizes, before + shard_postings - postings, "right")))
                waiting.append(batch.slice(start, end - start))
                postings, start = postings + int(sizes[end - 1] - before), end
                if postings >= shard_postings:
                    yield searched(pa.Table.from_batches(waiting).combine_chunks(), weights, wanted)
                    waiting, postings = [], 0
        if waiting:
            yield searched(pa.Table.from_batches(waiting).combine_chunks(), weights, wanted)

    def searched(table: pa.Table, weights: np.ndarray, wanted: list) -> pa.RecordBatch:
        keys, terms, times = (table[c].combine_chunks() for c in ("key", "terms", "times"))
        ends = np.cumsum(pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64))
        damping = 100 - percent + (percent * table["n"].to_numpy().astype(np.int64) * documents) // words
        tf = times.flatten().to_numpy().astype(np.int64)
        held = terms.flatten().to_numpy()
        sizes = np.diff(np.append(0, ends))
        impact = SCALE * tf // (1000 * tf + 8 * np.repeat(damping, sizes))
        order = np.empty(len(keys), np.int64)
        order[pc.array_sort_indices(keys).to_numpy()] = np.arange(len(keys))
        shard = Shard(ends, held, impact * weights[held], order, len(weights), block)
        found = [shard.search(t, n, limit) for t, n in wanted]
        counts = [len(d) for d, _ in found]
        take = np.concatenate([d for d, _ in found]) if found else np.zeros(0, np.int64)
        scores = np.concatenate([s for _, s in found]) if found else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(found)), counts)), keys.take(pa.array(take)), pa.array(scores)], ["nr", "key", "score"])

    kind = rows.schema["key"].dataType.simpleString()
    best = rows.select("key", "n", "terms", "times").mapInArrow(search, f"nr long, key {kind}, score long")
    order = [F.desc("score"), F.col("key").asc_nulls_last()]
    # first among some shards, so that no task gets the rows of all
    some = Window.partitionBy("nr", "some").orderBy(*order)
    best = best.withColumn("some", F.pmod(F.spark_partition_id(), F.lit(256))).withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= limit)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("nr").orderBy(*order))).filter(F.col("rank") <= limit)
    names = spark.createDataFrame(pa.table({"nr": pa.array(np.arange(len(queries))), "item": asked["item"].combine_chunks()}))
    return best.join(F.broadcast(names), "nr").select("item", "rank", "key", "score")
