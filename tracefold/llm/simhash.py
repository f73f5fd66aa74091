"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are 64 bits of majority votes over the hashes of word shingles. Distinct fingerprints
stand in a binary trie; pairs of nodes are walked down together, the bits in which their paths differ
are added up, and a pair is dropped once they exceed the error budget.

At most 4 differing bits means at most 2 in the first or in the last 32 bits. So there are two walks,
the second over fingerprints with their halves exchanged, and each allows 2 errors in its first half.
The pairs of nodes at a fixed depth are the tasks of the join. Within a task, subtrees already known
to be one component are not walked again, and only a spanning set of links is returned; components
of those links are found with joins. No more than one row per fingerprint, node pair and walk is made.

Defined cases: a null or empty text has fingerprint zero, linked like any other. Equal rows are kept
apart. A component of rows without ids has a null id; else its id is its smallest non-null one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracefold.llm.common import written
from tracefold.llm.components import connected

U64 = np.uint64
SEED = 42


def fingerprint(text: str | None, shingle: int = 4) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    size, digest = min(shingle, len(words)), xxhash.xxh64_intdigest
    hashes = np.array([digest(flat[a:b], SEED) for a, b in zip(starts, ends[size - 1:])], "<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        part = hashes[k:k + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_of(text: Column, shingle: int = 4) -> Column:
    """The fingerprint as a signed long."""

    @F.arrow_udf("long")
    def vote(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(np.array([fingerprint(t.as_py(), shingle) for t in batch], U64).view(np.int64), pa.int64())

    return vote(text)


class Forest:
    """Union-find over positions, by arrays."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def join(self, u: np.ndarray, v: np.ndarray) -> None:
        while True:
            a, b = self.root[u], self.root[v]
            apart = a != b
            if not apart.any():
                return
            u, v, a, b = u[apart], v[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                above = self.root[self.root]
                if (above == self.root).all():
                    break
                self.root = above


class TrieWalk:
    """Pairs of nodes of one or two tries, given as sorted fingerprints below a common depth."""

    LEAF, CHUNK, CHECKS = 256, 1 << 16, 1 << 21

    def __init__(self, a: np.ndarray, b: np.ndarray | None, depth: int, budget: int, half_budget: int):
        self.same = b is None
        self.values = a if self.same else np.concatenate([a, b])
        self.n_a, self.depth, self.budget, self.half_budget = len(a), depth, budget, half_budget
        self.forest = Forest(len(self.values))
        self._mark()

    def _mark(self) -> None:
        """For each position the end of the run of positions with its component."""
        root = self.forest.root
        last = np.flatnonzero(np.append(root[1:] != root[:-1], True))
        self.run_end = last[np.searchsorted(last, np.arange(len(root)))] + 1

    def _link(self, i: np.ndarray, j: np.ndarray) -> bool:
        near = np.bitwise_count(self.values[i] ^ self.values[j]) <= self.budget
        if near.any():
            self.forest.join(i[near], j[near])
        return bool(near.any())

    def _is_one(self, alo, ahi, blo, bhi):
        root = self.forest.root
        return (root[alo] == root[blo]) & (self.run_end[alo] >= ahi) & (self.run_end[blo] >= bhi)

    def _middle(self, lo, hi, depth):
        """Where the next bit turns to 1 within each range; all values of a range share the bits before."""
        bit = U64(63 - depth)
        turn = ((self.values[lo] >> bit) | U64(1)) << bit
        if self.same:
            at = np.searchsorted(self.values, turn)
        else:
            at = np.where(lo < self.n_a, np.searchsorted(self.values[:self.n_a], turn),
                          self.n_a + np.searchsorted(self.values[self.n_a:], turn))
        return np.clip(at, lo, hi)

    def _leaves(self, alo, ahi, blo, bhi) -> None:
        sizes = (ahi - alo) * (bhi - blo)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // self.CHECKS)) + 1
        for part in np.split(np.arange(len(sizes)), cuts):
            part = part[~self._is_one(alo[part], ahi[part], blo[part], bhi[part])]
            if not len(part):
                continue
            n = sizes[part]
            of = np.repeat(np.arange(len(part)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            wide = (bhi - blo)[part][of]
            i, j = alo[part][of] + at // wide, blo[part][of] + at % wide
            apart = i < j if self.same else slice(None)
            if self._link(i[apart], j[apart]):
                self._mark()

    def run(self) -> np.ndarray:
        """The component of each position, as a position."""
        n = len(self.values)
        for step in (1, 2, 3, 4):  # neighbours in order share most bits: dense groups are joined before the walk
            i = np.arange(n - step) if n > step else np.arange(0)
            self._link(i, i + step)
        self._mark()
        whole = (np.array([0]), np.array([self.n_a])) * 2 if self.same else (
            np.array([0]), np.array([self.n_a]), np.array([self.n_a]), np.array([n]))
        stack = [(self.depth, *whole)]
        while stack:
            depth, alo, ahi, blo, bhi = stack.pop()
            if depth:
                errors = np.bitwise_count((self.values[alo] ^ self.values[blo]) >> U64(64 - depth))
                keep = errors <= (self.half_budget if depth <= 32 else self.budget)
                keep &= ~self._is_one(alo, ahi, blo, bhi)
                alo, ahi, blo, bhi = alo[keep], ahi[keep], blo[keep], bhi[keep]
            leaf = ((ahi - alo) * (bhi - blo) <= self.LEAF) | (depth == 64)
            if leaf.any():
                self._leaves(alo[leaf], ahi[leaf], blo[leaf], bhi[leaf])
                alo, ahi, blo, bhi = alo[~leaf], ahi[~leaf], blo[~leaf], bhi[~leaf]
            if not len(alo):
                continue
            a, b = self._middle(alo, ahi, depth), self._middle(blo, bhi, depth)
            own = (alo == blo) & (ahi == bhi) & self.same
            parts = [(alo, a, blo, b), (a, ahi, b, bhi), (alo, a, b, bhi), (a[~own], ahi[~own], blo[~own], b[~own])]
            down = [np.concatenate(x) for x in zip(*parts)]
            full = (down[1] > down[0]) & (down[3] > down[2])
            down = [x[full] for x in down]
            for k in range(0, len(down[0]), self.CHUNK):
                stack.append((depth + 1, *(x[k:k + self.CHUNK] for x in down)))
        return self.forest.root


def exchanged(values: np.ndarray) -> np.ndarray:
    return (values << U64(32)) | (values >> U64(32))


def near_links(prints: DataFrame, *, budget: int = 4, node_size: int = 1 << 20, least_depth: int = 6) -> DataFrame:
    """Spanning links (u, v) between distinct fingerprints (fp) that differ in at most ``budget`` bits."""
    depth = min(30, max(least_depth, math.ceil(math.log2(max(1, prints.count()) / node_size))))
    half = budget // 2
    masks = np.array([sum(1 << b for b in bits) for k in range(half + 1) for bits in combinations(range(depth), k)], U64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The fingerprints of a batch by pair of nodes: walk, lower node, upper node, their sorted values."""
        for batch in batches:
            own = np.sort(batch.column(0).to_numpy().view(U64))
            keys: list[list[int]] = [[], [], []]
            blobs = []
            for walk, values in enumerate((own, np.sort(exchanged(own)))):
                nodes = values >> U64(64 - depth)
                cuts = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1])) if len(nodes) else np.arange(0)
                for lo, hi in zip(cuts, np.append(cuts[1:], len(nodes))):
                    blob, other = values[lo:hi].tobytes(), nodes[lo] ^ masks
                    keys[0] += [walk] * len(masks)
                    keys[1] += np.minimum(other, nodes[lo]).tolist()
                    keys[2] += np.maximum(other, nodes[lo]).tolist()
                    blobs += [blob] * len(masks)
            for k in range(0, len(blobs), 2000):
                yield pa.RecordBatch.from_arrays([*(pa.array(x[k:k + 2000], pa.int64()) for x in keys), pa.array(blobs[k:k + 2000], pa.binary())],
                                                 ["walk", "low", "high", "values"])

    def walk(key: tuple, table: pa.Table) -> pa.Table:
        which, low, high = (k.as_py() for k in key)
        values = np.unique(np.concatenate([np.frombuffer(x.as_py(), U64) for x in table["values"]]))
        if low == high:
            trie = TrieWalk(values, None, depth, budget, half)
        else:
            at = np.searchsorted(values, U64(high) << U64(64 - depth))
            trie = TrieWalk(values[:at], values[at:], depth, budget, half)
        root = trie.run() if 0 < trie.n_a < len(values) or low == high else np.arange(len(values))
        found = np.flatnonzero(root != np.arange(len(values)))
        ends = [values[found], values[root[found]]]
        ends = [exchanged(x) if which else x for x in ends]
        return pa.table({"u": ends[0].view(np.int64), "v": ends[1].view(np.int64)})

    return (prints.select("fp").mapInArrow(deal, "walk long, low long, high long, values binary")
            .groupBy("walk", "low", "high").applyInArrow(walk, "u long, v long"))


def component_roots(prints: DataFrame, *, budget: int = 4, **options) -> DataFrame:
    """fp, root, first for each distinct fingerprint of (doc_id, fp): its component and its smallest doc_id."""
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = connected(near_links(distinct, budget=budget, **options))
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", *, shingle: int = 4, budget: int = 4, **options) -> DataFrame:
    """For each row its key, fp (a signed long) and component_id, the smallest key linked to it, however far."""
    prints = written(docs.select(F.col(key).alias("doc_id"), fingerprint_of(F.col(text), shingle).alias("fp")), "prints")
    roots = component_roots(prints, budget=budget, **options)
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = roots.join(least, "root").select("fp", "component_id")
    return prints.join(ids, "fp").select(F.col("doc_id").alias(key), "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", *, shingle: int = 4, budget: int = 4, **options) -> DataFrame:
    """One row of each component, that with the smallest key (null keys last, of equal keys any one); all columns stay."""
    rows = written(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"),
                               fingerprint_of(F.col(text), shingle).alias("fp")), "documents")
    prints = rows.select("doc_id", "fp", "row")
    roots = component_roots(prints, budget=budget, **options).select("fp", "root")
    # the best row of each fingerprint comes first, so that a common one is not joined row by row
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("best")
    by_print = prints.groupBy("fp").agg(best)
    keep = by_print.join(roots, "fp").groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias("keep"))
    return rows.join(keep, F.col("row") == F.col("keep"), "left_semi").select("doc.*")
