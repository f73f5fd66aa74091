"""Benchmark decontamination by a prefix-filtered set join.

Every item gives windows of ``window`` consecutive words (a shorter item is one window). A window is
the set of its word shingles. Shingles are ordered by how rare they are in the documents. As a window
must be contained whole, its necessary prefix is its single rarest shingle: a document without it
cannot hold the window. Places of prefix shingles in a document are joined with the windows, placed
by the shingle's position in the window, bounded by the document's length, and verified word by word.

Items are sent to the tasks in blocks of about ``block_bytes`` of text; documents pass all blocks.

Defined cases: a null or empty text has no words; an item without words matches nothing; rows of
items with one id are one item; windows of an item without an id are hit but not listed. An item's
window may be found in many places; each word counts once.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracefold.llm.common import written

# A-Z to a-z; everything else of ASCII but letters and digits to a space
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SPANS = "array<struct<start:int,end:int>>"


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(FOLD).split() if text else []


def windows_of(words: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    size = min(size, len(words))
    return [tuple(words[k:k + size]) for k in range(len(words) - size + 1)]


def shingles_of(window: tuple[bytes, ...], size: int) -> list[tuple[bytes, ...]]:
    return windows_of(list(window), size)


class PrefixIndex:
    """The windows of a block of items, found by their rarest shingle."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int, shingle: int):
        self.shingle = shingle
        self.windows: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        for item, text in items:
            for w in windows_of(words_of(text), window):
                self.windows[w] |= {item} - {None}
        self.places: dict[tuple[bytes, ...], list[tuple[int, tuple[bytes, ...]]]] = {}

    def shingles(self) -> set[tuple[bytes, ...]]:
        return {s for w in self.windows for s in shingles_of(w, self.shingle)}

    def order(self, counts: dict[bytes, int]) -> PrefixIndex:
        """Keep each window under its rarest shingle; unseen ones are the rarest."""
        places = defaultdict(list)
        for w in self.windows:
            listed = shingles_of(w, self.shingle)
            at = min(range(len(listed)), key=lambda k: (counts.get(b" ".join(listed[k]), 0), listed[k]))
            places[listed[at]].append((at, w))
        # windows whose rarest shingle no document has are nowhere
        self.places = {s: found for s, found in places.items() if counts.get(b" ".join(s), 0)}
        return self

    def find(self, words: list[bytes], heads: dict[bytes, set[int]]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans of hit words, and the ids of items found."""
        starts: set[tuple[int, int]] = set()
        items: set[str] = set()
        for at, shingle in occurrences(words, heads):
            for offset, window in self.places.get(shingle, ()):
                start, end = at - offset, at - offset + len(window)
                if start >= 0 and end <= len(words) and tuple(words[start:end]) == window:
                    starts.add((start, end))
                    items |= self.windows[window]
        spans: list[tuple[int, int]] = []
        for start, end in sorted(starts):
            if spans and start <= spans[-1][1]:
                spans[-1] = spans[-1][0], max(end, spans[-1][1])
            else:
                spans.append((start, end))
        return spans, items


def heads_of(shingles) -> dict[bytes, set[int]]:
    """First words of shingles, with the shingles' lengths."""
    heads = defaultdict(set)
    for s in shingles:
        heads[s[0]].add(len(s))
    return dict(heads)


def occurrences(words: list[bytes], heads: dict[bytes, set[int]]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
    for at, word in enumerate(words):
        if word in heads:
            for size in heads[word]:
                yield at, tuple(words[at:at + size])


def shingle_counts(docs: DataFrame, index, window: int, shingle: int) -> dict[bytes, int]:
    """How often the block's shingles occur in all documents; as many rows as the block has shingles."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = PrefixIndex(index.value, window, shingle).shingles()
        heads, seen = heads_of(wanted), Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(s for _, s in occurrences(words_of(text.as_py()), heads) if s in wanted)
        yield pa.RecordBatch.from_arrays(
            [pa.array([b" ".join(s) for s in seen], pa.binary()), pa.array(seen.values(), pa.int64())], ["shingle", "n"])

    found = docs.select("text").mapInArrow(count, "shingle binary, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    return {bytes(r.shingle): r.n for r in found.toLocalIterator()}


def find_contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                       item_text: str = "text", *, window: int = 10, shingle: int = 3, block_bytes: int = 16 << 20,
                       with_row: bool = False) -> DataFrame:
    """For each row its key, n_words, spans of hit words and item_ids found (sorted as text).

    ``with_row`` adds the row itself as ``doc``.
    """
    spark = docs.sparkSession
    items = items.select(F.col(item_key).cast("string").alias("item"), F.col(item_text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    blocks = 1 + size // block_bytes
    others = [F.struct(*(F.col(c) for c in docs.columns if c != text), F.lit(None).alias("_")).alias("others")] if with_row else []
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.lit(None).cast(SPANS).alias("spans"),
                       F.lit(None).cast("array<string>").alias("items"), F.lit(0).cast("long").alias("n_words"), *others)
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else items
        index = spark.sparkContext.broadcast([tuple(r) for r in part.distinct().collect()])
        counts = spark.sparkContext.broadcast(shingle_counts(rows, index, window, shingle))
        last = block + 1 == blocks
        out = [c for c in rows.columns if c != "text" or with_row or not last]
        rows = rows.mapInArrow(_matcher(index, counts, window, shingle, out), rows.select(*out).schema)
        if not last:
            rows = written(rows, "decontamination")
    found = [F.col("key").alias(key), "n_words", "spans", F.col("items").alias("item_ids")]
    if with_row:
        found.append(F.struct(*(F.col("text") if c == text else F.col(f"others.{c}") for c in docs.columns)).alias("doc"))
    return rows.select(*found)


def _matcher(index, counts, window: int, shingle: int, out: list[str]):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = PrefixIndex(index.value, window, shingle).order(counts.value)
        heads = heads_of(known.places)
        for batch in batches:
            n_words, spans, items = [], [], []
            for text, old_spans, old_items in zip(batch["text"], batch["spans"].to_pylist(), batch["items"].to_pylist()):
                words = words_of(text.as_py())
                found, listed = known.find(words, heads)
                before = [(s["start"], s["end"]) for s in old_spans or ()]
                merged: list[tuple[int, int]] = []
                for start, end in sorted([*before, *found]):
                    if merged and start <= merged[-1][1]:
                        merged[-1] = merged[-1][0], max(end, merged[-1][1])
                    else:
                        merged.append((start, end))
                n_words.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in merged])
                items.append(sorted({*(old_items or ()), *listed}))
            new = {"spans": pa.array(spans, kind), "items": pa.array(items, pa.list_(pa.string())), "n_words": pa.array(n_words, pa.int64())}
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch[c] for c in out], out)

    return match
