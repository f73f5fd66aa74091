"""Removal of repeated word sequences, found by recompression.

A word covered by a window of ``window`` words that starts earlier elsewhere (smaller document id, or
earlier in the document) is removed. Windows are judged on the input.

Texts are recompressed in rounds. The first names runs of equal words. Each of the others splits the
symbols in two halves by a bit of their name and names the pairs that go from one half to the other.
Names are made from what they name, so that equal words get equal symbols in all documents, and each
symbol keeps the range of words it depends on. Inside two equal windows the symbols that depend on no
word outside are the same. After some rounds a window still holds such symbols, and there are few:

1. Each group of documents deals its symbols out by name; those in other groups or twice in one are
   shared, and the group is told so by a bit for each.
2. A window all of whose own symbols are shared may be repeated. The group deals out what identifies
   these windows (96 bits of hash, document, place), the earliest of each only; the others it marks.
3. The earliest of all stays, the others are marked, and the groups drop the words of marked windows.

Documents are shuffled once; all three steps use the same exchange. A group never sends a symbol or a
window more than once, so common ones do not gather.

Defined cases: a null or empty text has no words. Rows with one id and different texts are ordered by
the texts' hashes; equal rows are one document and get the same result. Null ids come last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracefold.llm.common import shuffle_partitions

U64 = np.uint64
LAST = np.iinfo(np.int64).max
RECORD = np.dtype([("h1", "<u8"), ("h2", "<u4"), ("doc", "<i8"), ("version", "<u4"), ("at", "<u4")])
DEALT = "bucket long, p long, kind int, data binary"


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits to 64 bits, one to one."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class WordNames(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        name = self[word] = xxhash.xxh64_intdigest(word)
        return name


class Group:
    """The documents of a group with at least a window of words, one after the other, with separators around."""

    def __init__(self, table: pa.Table, window: int):
        rows = zip(table["row"].to_pylist(), table["version"].to_pylist(), table["doc_id"].to_pylist(), table["text"])
        self.docs = sorted({(r, v): (d, t.as_py()) for r, v, d, t in rows}.items())
        self.window, self.keys, self.starts, self.lengths = window, [], [], []
        names, held, at = WordNames(), [np.zeros(1, U64)], 1
        for (row, version), (doc, text) in self.docs:
            words = text.encode().split() if text else []
            if len(words) < window:
                continue
            held += [np.fromiter(map(names.__getitem__, words), U64, len(words)), np.zeros(1, U64)]
            self.keys.append((row, version, doc))
            self.starts.append(at)
            self.lengths.append(len(words))
            at += len(words) + 1
        self.words = np.concatenate(held)
        ends = np.array(self.starts, np.int64) + np.array(self.lengths, np.int64)
        self.separators = np.append(0, ends)

    def symbols(self, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Names, and the ranges of words they depend on, of the symbols that some window holds whole."""
        n = len(self.words)
        name = self.words.copy()
        # separators differ from each other and from words, as far as this group goes
        name[self.separators] = mixed(np.arange(len(self.separators), dtype=U64) + U64(0x5EED))
        new = np.append(True, name[1:] != name[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, n))
        name = np.where(size > 1, mixed(name[start] * U64(5) + size.astype(U64)), name[start])
        low, high = start - 1, start + size + 1
        for k in range(1, rounds + 1):
            right = (mixed(name ^ U64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) & U64(1)).astype(bool)
            pair = np.append(~right[:-1] & right[1:], False)
            # a symbol of the left half depends on the next one, paired or not; one of the right half on the one before
            to = np.where(right, high, np.append(high[1:], n + 1))
            of = np.where(right, np.append(-1, low[:-1]), low)
            at = np.flatnonzero(pair)
            name[at] = mixed(name[at] * U64(3) + mixed(name[at + 1]))
            keep = ~np.append(False, pair[:-1])
            name, low, high = name[keep], of[keep], to[keep]
        before = np.zeros(n + 1, np.int64)
        before[self.separators + 1] = 1
        before = np.cumsum(before)  # separators before each place
        inside = (high - low <= self.window) & (low >= 0) & (high <= n)
        inside &= before[np.clip(high, 0, n)] == before[np.clip(low, 0, n)]
        return name[inside], low[inside], high[inside]

    def window_starts(self) -> np.ndarray:
        return np.concatenate([np.arange(s, s + m - self.window + 1) for s, m in zip(self.starts, self.lengths)] or [np.arange(0)])

    def candidates(self, low: np.ndarray, high: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Starts of windows that hold no symbol that is not shared."""
        starts = self.window_starts()
        lone = np.append(0, np.cumsum(~shared))
        first = np.searchsorted(low, starts)
        end = np.maximum(np.searchsorted(high, starts + self.window, side="right"), first)
        return starts[lone[end] == lone[first]]

    def records(self, starts: np.ndarray) -> np.ndarray:
        a, b = np.zeros(len(starts), U64), np.zeros(len(starts), U64)
        for k in range(self.window):
            word = self.words[starts + k]
            a = a * U64(0x9E3779B97F4A7C15) + word
            b = b * U64(0xD1B54A32D192ED03) + (word ^ (word >> U64(29)))
        of = np.searchsorted(np.array(self.starts, np.int64), starts, side="right") - 1
        made = np.empty(len(starts), RECORD)
        made["h1"], made["h2"], made["at"] = mixed(a), (mixed(b) >> U64(32)).astype(np.uint32), starts
        made["doc"] = np.array([LAST if d is None else d for _, _, d in self.keys], np.int64)[of]
        made["version"] = (np.array([v for _, v, _ in self.keys], np.int64).view(U64) >> U64(32)).astype(np.uint32)[of]
        return made


def by_window(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Records in the order of window, document, place; and whether each is the first of its window."""
    records = records[np.lexsort((records["at"], records["version"], records["doc"], records["h2"], records["h1"]))]
    first = np.append(True, (records["h1"][1:] != records["h1"][:-1]) | (records["h2"][1:] != records["h2"][:-1]))[:len(records)]
    return records, first


def dealt(values: np.ndarray, bucket_of: np.ndarray, p: int, kind: int) -> list[dict]:
    """Values sorted by bucket, as one row for each bucket."""
    cuts = np.flatnonzero(np.append(True, bucket_of[1:] != bucket_of[:-1]))[:len(values)]
    return [{"bucket": int(bucket_of[a]), "p": p, "kind": kind, "data": values[a:b].tobytes()} for a, b in zip(cuts, np.append(cuts[1:], len(values)))]


def buckets_of(names: np.ndarray, buckets: int) -> np.ndarray:
    return (names >> U64(32)) * U64(buckets) >> U64(32)


def to_table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, pa.schema([("bucket", pa.int64()), ("p", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())]))


def named_symbols(group: Group, rounds: int) -> tuple[np.ndarray, ...]:
    """Distinct names, how often each occurs, the symbols' places among them, and their ranges."""
    name, low, high = group.symbols(rounds)
    distinct, place, times = np.unique(name, return_inverse=True, return_counts=True)
    return distinct, times, place, low, high


def share_names(table: pa.Table) -> pa.Table:
    """For the names of a bucket: to each group a bit for each of its names, set if another group has it too."""
    held = [np.frombuffer(d.as_py(), U64) for d in table["data"]]
    names, times = np.unique(np.concatenate(held), return_counts=True)
    rows = []
    for bucket, p, own in zip(table["bucket"].to_pylist(), table["p"].to_pylist(), held):
        shared = times[np.searchsorted(names, own)] > 1
        rows.append({"bucket": bucket, "p": p, "kind": 1, "data": np.packbits(shared).tobytes()})
    return to_table(rows)


def later_windows(table: pa.Table) -> pa.Table:
    """For the windows of a bucket: to each group the places of those that are not the earliest."""
    rows, parts, owners = [], [], []
    for p, kind, data in zip(table["p"].to_pylist(), table["kind"].to_pylist(), table["data"]):
        if kind == 3:  # marked in their group already
            rows.append({"bucket": 0, "p": p, "kind": 2, "data": data.as_py()})
        else:
            parts.append(np.frombuffer(data.as_py(), RECORD))
            owners.append(np.full(len(parts[-1]), p))
    if parts:
        records, owner = np.concatenate(parts), np.concatenate(owners)
        order = np.lexsort((records["at"], records["version"], records["doc"], records["h2"], records["h1"]))
        records, owner = records[order], owner[order]
        later = np.append(False, (records["h1"][1:] == records["h1"][:-1]) & (records["h2"][1:] == records["h2"][:-1]))[:len(records)]
        at, owner = records["at"][later], owner[later]
        by = np.argsort(owner, kind="stable")
        rows += [{**r, "p": r.pop("bucket"), "bucket": 0} for r in dealt(at[by].astype("<u4"), owner[by], 0, 2)]
    return to_table(rows)


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text", *, window: int = 20, rounds: int = 4) -> DataFrame:
    """For each row its key, n_words, n_removed and the words that stay, joined by spaces, as ``text``."""
    n = shuffle_partitions(docs.sparkSession)
    groups, buckets = 2 * n, n
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(key).alias("row"), F.xxhash64(text).alias("version"))
    rows = rows.withColumn("p", F.pmod(F.xxhash64("row", "version"), F.lit(groups))).repartition(n, "p")

    def name(key: tuple, table: pa.Table) -> pa.Table:
        distinct, *_ = named_symbols(Group(table, window), rounds)
        return to_table(dealt(distinct, buckets_of(distinct, buckets), key[0].as_py(), 0))

    shared = rows.groupBy("p").applyInArrow(name, DEALT).groupBy("bucket").applyInArrow(share_names, DEALT)

    def identify(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        p = key[0].as_py()
        group = Group(table, window)
        distinct, times, place, low, high = named_symbols(group, rounds)
        bucket = buckets_of(distinct, buckets)
        is_shared = times > 1
        for b, data in zip(told["bucket"].to_pylist(), told["data"]):
            a, z = np.searchsorted(bucket, U64(b)), np.searchsorted(bucket, U64(b), side="right")
            is_shared[a:z] |= np.unpackbits(np.frombuffer(data.as_py(), np.uint8), count=z - a).astype(bool)
        records, first = by_window(group.records(group.candidates(low, high, is_shared[place])))
        out = dealt(records[first], buckets_of(records["h1"][first], buckets), p, 2)
        marked = records["at"][~first].astype("<u4")
        if len(marked):
            out.append({"bucket": p % buckets, "p": p, "kind": 3, "data": marked.tobytes()})
        return to_table(out)

    marked = (rows.groupBy("p").cogroup(shared.groupBy("p")).applyInArrow(identify, DEALT)
              .groupBy("bucket").applyInArrow(later_windows, DEALT))

    def drop(table: pa.Table, told: pa.Table) -> pa.Table:
        group = Group(table, window)
        edges = np.zeros(len(group.words) + window + 1, np.int64)
        for data in told["data"]:
            at = np.frombuffer(data.as_py(), "<u4").astype(np.int64)
            np.add.at(edges, at, 1)
            np.add.at(edges, at + window, -1)
        gone = np.cumsum(edges) > 0
        place = {(r, v): s for (r, v, _), s in zip(group.keys, group.starts)}
        columns: list[list] = [[], [], [], []]
        for row, version, doc, text in zip(*(table[c].to_pylist() for c in ("row", "version", "doc_id", "text"))):
            words = text.encode().split() if text else []
            start, stay = place.get((row, version)), words
            if start is not None:
                out = gone[start:start + len(words)]
                if out.any():
                    stay = [w for w, g in zip(words, out.tolist()) if not g]
            for column, value in zip(columns, (doc, len(words), len(words) - len(stay), b" ".join(stay).decode())):
                column.append(value)
        return pa.table([pa.array(columns[0], table["doc_id"].type), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
                         pa.array(columns[3], pa.string())], ["doc_id", "n_words", "n_removed", "text"])

    found = rows.groupBy("p").cogroup(marked.groupBy("p")).applyInArrow(drop, f"doc_id {kind}, n_words long, n_removed long, text string")
    return found.withColumnsRenamed({"doc_id": key, "text": text})
