"""Token ids of documents as Huffman-coded files, and reading them back.

Documents are ordered by id over range partitions and encoded; ids are counted over the whole corpus
and give one canonical length-limited code. Each partition writes a file: a head with the code's
lengths, then blocks of whole documents that can be decoded on their own. A block lists its documents
and the bit offset of every 64th id, so that decoding starts at all of them at once.

Texts are encoded in parts: no token of a byte-level vocabulary has a white space after another
character, so a text is cut before every run of white space. Arrow numbers the distinct parts of a
block of texts; only these are looked up in a worker's cache, and those that it lacks are encoded.

Defined cases: a null or empty text has only the end id. A null document id comes first. Rows with
the same id follow each other in the order of their texts' hashes. No documents give no files.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracefold.cluster import cut_lineage
from tracefold.llm.common import PartCache, blocks_of, shuffle_partitions, take_lists
from tracefold.llm.huffman import Code, code_lengths

# \x1c-\x1f are white space for Python only
PART = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
WHITE = [chr(c).encode() for c in range(0x3001) if PART.fullmatch(chr(c) + " ")]
ASCII_WHITE = np.isin(np.arange(256), [c[0] for c in WHITE if len(c) == 1])
#: What follows the first byte of the other white space.
WHITE_TAILS = {lead: [c[1:] for c in WHITE if c[0] == lead] for lead in sorted({c[0] for c in WHITE if len(c) > 1})}
MAGIC, HEAD, BLOCK = b"THUF1", "<IQI", "<QII"
BLOCK_IDS = 1 << 16
BLOCK_BYTES = 4 << 20


class CachedEncoder(PartCache):
    """Ids of texts as little-endian unsigned 32-bit numbers; ``plain``: special strings in a text are ordinary text.

    Plain parts of byte-level vocabularies go to the tokenizer's model. Many others go through the tokenizer in one call,
    with a special token between them, which cuts a text before all other rules.
    """

    def __init__(self, tokenizer_file: str, held: int = 800_000, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        from tracefold.llm.byte_parts import ByteParts

        super().__init__(held)
        self.tokenizer, self.plain = Tokenizer.from_file(tokenizer_file), plain
        special = [(k, t.content) for k, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not t.normalized]
        self.cut_id, self.cut = special[0] if special else (None, None)
        self.byte_parts = ByteParts(self.tokenizer) if ByteParts.fits(self.tokenizer) else None

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        if not self.byte_parts or not parts:
            return self.encode_odd(parts)
        plain, ids = self.byte_parts.encode(parts)
        odd = [part for part, taken in zip(parts, plain.tolist()) if not taken]
        if not odd:
            return ids
        by_kind = iter(ids), iter(self.encode_odd(odd))
        return [next(by_kind[not taken]) for taken in plain.tolist()]

    def encode_odd(self, parts: list[str]) -> list[bytes]:
        """By all rules of the tokenizer."""
        alone = [k for k, part in enumerate(parts) if self.cut is None or self.cut[0] in part]
        apart = set(alone)
        together = [k for k in range(len(parts)) if k not in apart]
        found = [b""] * len(parts)
        # parts that may hold the special string themselves
        self.tokenizer.encode_special_tokens = self.plain
        for k, encoding in zip(alone, self.tokenizer.encode_batch_fast([parts[k] for k in alone], add_special_tokens=False)):
            found[k] = array("I", encoding.ids).tobytes()
        self.tokenizer.encode_special_tokens = False
        groups = [together[k:k + 128] for k in range(0, len(together), 128)]
        texts = [self.cut.join([parts[k] for k in group]) for group in groups]
        for group, encoding in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(encoding.ids, "<u4")
            content, cuts = ids.tobytes(), (np.flatnonzero(ids == self.cut_id) * 4).tolist()
            for k, a, z in zip(group, [0, *[c + 4 for c in cuts]], [*cuts, len(content)]):
                found[k] = content[a:z]
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        ids, upto = self.ids_of(pa.array(texts, pa.string()))
        content, ends = ids.tobytes(), (upto * 4).tolist()
        return [content[a:z] for a, z in zip([0, *ends], ends)]

    def ids_of(self, texts: pa.Array, last: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, ``last`` behind each, one after the other, and where each text's ids end."""
        content, ends = content_of(texts)
        starts = part_starts(content, ends)
        offsets = np.append(starts, len(content)).astype(np.int32)
        parts = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(content)).dictionary_encode()
        found = self.lookup(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        values = np.append(np.frombuffer(b"".join(found), "<u4"), np.array(last, "<u4"))
        value_ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) // 4
        # one more part ends every text
        upto = np.searchsorted(starts, ends)
        which = np.insert(parts.indices.to_numpy(), upto, len(found))
        return take_lists(values, np.append(value_ends, len(values)), which, upto + np.arange(1, len(upto) + 1))


def content_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each text ends; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, ends, content = texts.buffers()
    if not len(texts) or content is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts), np.int64)
    ends = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return np.frombuffer(content, np.uint8)[ends[0]:ends[-1]], ends[1:] - ends[0]


def part_starts(content: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the parts of texts start: the same as PART finds in each."""
    white = ASCII_WHITE[content]
    for lead, following in WHITE_TAILS.items():
        places = np.flatnonzero(content == lead)
        # a lead byte has its whole character behind it
        for tail in following if len(places) else ():
            here = places
            for k, byte in enumerate(tail, 1):
                here = here[content[here + k] == byte]
            for k in range(len(tail) + 1):
                white[here + k] = True
    cut = white.copy()
    cut[1:] &= ~white[:-1]
    starts = np.append(0, ends[:-1])[np.diff(ends, prepend=0) > 0]
    cut[starts] = True
    return np.flatnonzero(cut)


@lru_cache(maxsize=1)
def encoder_of(tokenizer_file: str) -> CachedEncoder:
    """The encoder of a worker process, kept from task to task."""
    return CachedEncoder(tokenizer_file)


def encode_documents(docs: DataFrame, tokenizer_file: str, key: str = "doc_id", text: str = "text", end_id: int = 0,
                     vocabulary: int = 1 << 16) -> DataFrame:
    """part, doc_id and ids for each row, parts and rows by rising id; ids have 2 bytes each if ``vocabulary`` allows, else 4."""
    spark = docs.sparkSession
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, size = encoder_of(tokenizer_file), np.dtype(width).itemsize
        for batch in batches:
            for a, z in blocks_of(batch["text"], BLOCK_BYTES):
                ids, upto = encoder.ids_of(batch["text"].slice(a, z - a), (end_id,))
                offsets = pa.py_buffer(np.append(0, upto * size).astype(np.int32))
                rows = pa.Array.from_buffers(pa.binary(), z - a, [None, offsets, pa.py_buffer(ids.astype(width))])
                yield pa.RecordBatch.from_arrays([*(batch[c].slice(a, z - a) for c in ("part", "doc_id")), rows], ["part", "doc_id", "ids"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("version"))
    ordered = rows.repartitionByRange(shuffle_partitions(spark), "doc_id", "version").sortWithinPartitions("doc_id", "version")
    return ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(encode, "part int, doc_id long, ids binary")


def write_files(encoded: DataFrame, path: str, vocabulary: int = 1 << 16) -> None:
    """Write the files below ``path``. ``encoded`` is kept by a checkpoint, which keeps parts and their order."""
    spark = encoded.sparkSession
    encoded = cut_lineage(encoded)
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts by id of a part, and under id -1 its number of ids."""
        seen, part = np.zeros(vocabulary, np.int64), 0
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                ids = np.frombuffer(b"".join(batch["ids"].slice(k, 500).to_pylist()), width)
                seen += np.bincount(ids, minlength=vocabulary)
            if batch.num_rows:
                part = batch["part"][0].as_py()
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1 - part), pa.int64()), pa.array(np.append(seen[used], seen.sum()), pa.int64())], ["id", "n"])

    # a row for each id of the vocabulary and each part
    found = encoded.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = found["id"].to_numpy(), found["n"].to_numpy()
    counts = np.zeros(vocabulary, np.int64)
    counts[ids[ids >= 0]] = n[ids >= 0]
    sizes = dict(sorted(zip((-1 - ids[ids < 0]).tolist(), n[ids < 0].tolist())))
    before = dict(zip(sizes, np.cumsum([0, *sizes.values()]).tolist()))
    shared = spark.sparkContext.broadcast((code_lengths(counts), before))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pieces of a file, each with its length in front."""
        lengths, before = shared.value
        code, at, waiting, held = Code(lengths), None, [], 0

        def block() -> bytes:
            nonlocal at
            sizes = np.array([len(i) for _, i in waiting], "<u4") // np.dtype(width).itemsize
            ids = np.frombuffer(b"".join(i for _, i in waiting), width)
            offsets, bits = code.encode(ids)
            keys = np.array([d or 0 for d, _ in waiting], "<i8")
            nulls = np.array([d is None for d, _ in waiting], np.uint8)
            body = struct.pack(BLOCK, at, len(waiting), len(ids)) + b"".join(x.tobytes() for x in (keys, nulls, sizes, offsets)) + bits
            at += len(ids)
            return struct.pack("<I", len(body)) + body

        def piece(content: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

        for batch in batches:
            for part, key, ids in zip(batch["part"], batch["doc_id"].to_pylist(), batch["ids"]):
                if at is None:
                    at = before[part.as_py()]
                    table = zlib.compress(lengths.tobytes())
                    yield piece(MAGIC + struct.pack(HEAD, part.as_py(), at, len(table)) + table)
                waiting.append((key, ids.as_py()))
                held += len(waiting[-1][1])
                if held >= BLOCK_IDS * np.dtype(width).itemsize:
                    yield piece(block())
                    waiting, held = [], 0
        if waiting:
            yield piece(block())

    # Spark's text files take any bytes; a line end follows every piece
    encoded.mapInArrow(pack, "content binary").select(F.col("content").cast("string").alias("value")).write.text(path)


def unpack(content: bytes) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """Key, start and ids of each document of a file."""
    if not content:
        return
    if content[:len(MAGIC)] != MAGIC:
        raise ValueError("not a token file")
    _, _, size = struct.unpack_from(HEAD, content, len(MAGIC))
    at = len(MAGIC) + struct.calcsize(HEAD)
    code = Code(np.frombuffer(zlib.decompress(content[at:at + size]), np.uint8))
    at += size + 1
    while at < len(content):
        (size,) = struct.unpack_from("<I", content, at)
        start, n_docs, n_ids = struct.unpack_from(BLOCK, content, at + 4)
        place = at + 4 + struct.calcsize(BLOCK)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal place
            found = np.frombuffer(content, kind, n, place)
            place += found.nbytes
            return found

        keys, nulls, sizes = take("<i8", n_docs), take("u1", n_docs), take("<u4", n_docs)
        offsets = take("<u4", -(-n_ids // 64))
        ids = code.decode(offsets, content[place:at + 4 + size], n_ids)
        ends = np.cumsum(sizes, dtype=np.int64)
        for key, null, end, n in zip(keys.tolist(), nulls, ends.tolist(), sizes.tolist()):
            yield None if null else key, start + end - n, ids[end - n:end]
        at += 4 + size + 1


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids before the document's) and ids (little-endian unsigned 32-bit numbers) of each document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                rows: list[list] = [[], [], []]
                for key, start, ids in unpack(content.as_py()):
                    for column, value in zip(rows, (key, start, ids.astype("<u4").tobytes())):
                        column.append(value)
                    if len(rows[0]) == 500:
                        yield made(rows)
                        rows = [[], [], []]
                yield made(rows)

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary())],
                                          ["doc_id", "start", "ids"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(read, "doc_id long, start long, ids binary")
