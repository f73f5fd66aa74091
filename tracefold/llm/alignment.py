"""Alignment of two tokenizers over a corpus, with Arrow tables inside the tasks and Spark between them.

A is a byte-level vocabulary of the tokenizers library, B a sentencepiece model with byte fallback. Both
encode a text with a space in front of it. Token lists are flattened to columns with their parents (the
documents); byte lengths are summed up within each document to token ends. A hash join of A's and B's
(document, end) keys finds where tokens of both end. These places cut a document into groups. Between two
neighbouring ends of either side lies exactly one pair of overlapping tokens, so the outer join of the same
keys, put in order and filled from behind, lists every link.

Texts are encoded and aligned once; a document's distinct pairs are written. The documents that hold a pair
are counted per task with ``Table.group_by``; Spark adds these counts up. The most frequent pairs, at most ``head_size``, go to all tasks and are joined there; the others are
joined by a shuffle.

Defined cases: a null or empty text, and one whose tokens of either side do not join to its bytes (a text with
the space mark of B, say), has no tokens, groups or links. Repeated rows stay apart and count as documents of
their own. Special strings in texts are plain text.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracefold.llm.common import PartCache, blocks_of, written
from tracefold.llm.token_counts import PRE_TOKEN, SPACE, frequent
from tracefold.llm.token_files import PART, CachedEncoder

NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
# a document's distinct pairs: A ids, B ids, and the links of each
LISTS = ["pair_a", "pair_b", "times"]
#: A pair of ids is one number: the A id times this, plus the B id. Vocabularies are smaller.
PAIR = 1 << 31
DOC = 1 << 40
GROUPS = "array<struct<a:array<int>,b:array<int>>>"


class BothEncoder(PartCache):
    """Ids of texts, a space put in front, by both tokenizers. Parts are cut where no token of either crosses."""

    # white space but spaces and line ends, where B has no cut, and B's mark, where A has none
    ODD = re.compile(rf"[^\S \n\x1c-\x1f]|{SPACE}")

    def __init__(self, a_file: str, b_file: str, held: int = 300_000):
        import sentencepiece

        super().__init__(held)
        self.bytes = CachedEncoder(a_file, 0, plain=True)
        self.model = sentencepiece.SentencePieceProcessor(model_file=b_file)
        self.line = self.model.encode("\n")[-1]

    def encode_parts(self, parts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        pieces: list[bytes] = [b""] * len(parts)
        with_lines = [k for k, p in enumerate(parts) if "\n" in p or SPACE in p]
        for k, ids in zip(with_lines, self.encode_pieces([parts[k] for k in with_lines])):
            pieces[k] = ids
        apart = set(with_lines)
        plain = [k for k in range(len(parts)) if k not in apart]
        for k, ids in zip(plain, self.encode_lines([parts[k] for k in plain])):
            pieces[k] = ids
        return zip(self.bytes.encode_parts(parts), pieces)

    def encode_pieces(self, parts: list[str]) -> list[bytes]:
        """B's ids of parts that hold line ends or marks."""
        cut = [PRE_TOKEN.findall(p.replace(" ", SPACE)) for p in parts]
        lines = self.encode_lines([p for p in chain.from_iterable(cut) if p != "\n"])
        line, of_line = array("I", [self.line]).tobytes(), iter(lines)
        return [b"".join([line if p == "\n" else next(of_line) for p in pieces]) for pieces in cut]

    def encode_lines(self, parts: list[str]) -> list[bytes]:
        """B's ids of parts without line ends: many in one call, with line ends, which are tokens of their own, between them."""
        found: list[bytes] = []
        # the processor's own mark comes before the first line end
        texts = ["\n" + "\n".join(parts[k:k + 128]) for k in range(0, len(parts), 128)]
        for ids in self.model.encode(texts, num_threads=1):
            ids = np.array(ids, "<u4")
            content, ends = ids.tobytes(), (np.flatnonzero(ids == self.line) * 4).tolist()
            found += [content[a + 4:z] for a, z in zip(ends, [*ends[1:], len(content)])]
        return found

    def encode(self, texts: list[str | None]) -> tuple[pa.ListArray, pa.ListArray]:
        """The ids of both sides; null and empty texts have none."""
        parts = [PART.findall(" " + t) if t and not self.ODD.search(t) else [] for t in texts]
        values = self.lookup(list(chain.from_iterable(parts)))
        upto = np.cumsum([0, *map(len, parts)])
        odd = [k for k, t in enumerate(texts) if t and not parts[k]]
        whole = list(self.encode_parts([" " + texts[k] for k in odd]))
        sides = []
        for side in (0, 1):
            pieces = [v[side] for v in values]
            ends = np.append(0, np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))))[upto] // 4
            content = b"".join(pieces)
            if odd:
                own = [content[a * 4:z * 4] for a, z in zip(ends.tolist(), ends[1:].tolist())]
                for k, ids in zip(odd, whole):
                    own[k] = ids[side]
                content, ends = b"".join(own), np.cumsum([0, *map(len, own)]) // 4
            sides.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(content, np.int32))))
        return sides[0], sides[1]


def byte_tokens(tokenizer_file: str) -> list[bytes | None]:
    """The bytes of each id of a byte-level vocabulary, whose letters stand for bytes in a fixed order."""
    from tokenizers import Tokenizer

    # printable bytes stand for themselves, the others for the letters from 256 on
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
    vocab = Tokenizer.from_file(tokenizer_file).get_vocab(with_added_tokens=False)
    found: list[bytes | None] = [None] * (max(vocab.values()) + 1)
    for token, k in vocab.items():
        found[k] = bytes(map(letters.__getitem__, token))
    return found


def piece_tokens(model) -> list[bytes]:
    """The bytes of each piece: the space mark is a space, a byte piece its byte."""
    texts = ((k, model.id_to_piece(k)) for k in range(model.get_piece_size()))
    return [bytes([int(p[3:-1], 16)]) if model.is_byte(k) else p.replace(SPACE, " ").encode() for k, p in texts]


class Tokens:
    """The bytes and the written numbers of one tokenizer's ids."""

    def __init__(self, tokens: list[bytes | None]):
        self.bytes = pa.array(tokens, pa.binary())
        self.sizes = pc.fill_null(pc.binary_length(self.bytes), 0).cast(pa.int64())
        self.numbers = pa.array(map(str, range(len(tokens))), pa.string())

    def bytes_of(self, ids: pa.ListArray) -> pa.Array:
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.bytes.take(ids.flatten())), b"")


@lru_cache(maxsize=1)
def encoder_of(a_file: str, b_file: str) -> BothEncoder:
    """The encoder of a worker process, kept from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return BothEncoder(a_file, b_file)


@lru_cache(maxsize=1)
def sides_of(a_file: str, b_file: str) -> tuple[Tokens, Tokens]:
    import sentencepiece

    return Tokens(byte_tokens(a_file)), Tokens(piece_tokens(sentencepiece.SentencePieceProcessor(model_file=b_file)))


def token_ends(ids: pa.ListArray, sizes: pa.Array, name: str) -> pa.Table:
    """(at, id): the lists flattened; ``at`` is the key of a document and a byte end in it, DOC times the one plus the other."""
    flat = ids.flatten()
    total = pc.cumulative_sum(sizes.take(flat))
    # what was summed up before each list starts
    before = pa.concat_arrays([pa.array([0], pa.int64()), total])
    starts = before.take(pc.subtract(ids.offsets, ids.offsets[0])[:len(ids)])
    parents = pc.list_parent_indices(ids)
    ends = pc.subtract(total, starts.take(parents))
    return pa.table({"at": pc.add(pc.multiply(parents.cast(pa.int64()), DOC), ends), name: flat})


def overlaps(a: pa.ListArray, b: pa.ListArray, sides: tuple[Tokens, Tokens]) -> pa.Table:
    """Every link (doc, a, b) in order, with ``a_ends`` and ``b_ends``: whether a token of that side ends with it."""
    left, right = token_ends(a, sides[0].sizes, "a"), token_ends(b, sides[1].sizes, "b")
    both = left.join(right, "at", join_type="full outer", use_threads=False)
    both = both.take(pc.array_sort_indices(both["at"].combine_chunks()))
    # a document's last end is one of both sides, so no id is filled in from the document after it
    filled = {c: pc.fill_null_backward(both[c].combine_chunks()) for c in "ab"}
    return pa.table({"doc": pc.divide(both["at"], DOC), **filled, **{f"{c}_ends": both[c].is_valid() for c in "ab"}})


def pairs_of(links: pa.Table) -> pa.Table:
    """(doc, pair, times) for each distinct pair of a document."""
    pair = pc.add(pc.multiply(links["a"].cast(pa.int64()), PAIR), links["b"].cast(pa.int64()))
    counted = pa.table({"doc": links["doc"], "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    return counted.rename_columns({"count_all": "times"})


def groups_of(a: pa.ListArray, b: pa.ListArray, links: pa.Table, rows: int, sides: tuple[Tokens, Tokens] | None = None) -> pa.Array:
    """For each of ``rows`` rows its groups: lists of structs of the lists a and b, or, with ``sides``, a text like ``a1,a2|b1;a3|b2``."""
    shared = pc.and_(links["a_ends"], links["b_ends"])

    def cut(name: str, values: pa.Array) -> pa.ListArray:
        """The values of all rows, cut by the number of tokens up to each shared end."""
        upto = pc.cumulative_sum(links[f"{name}_ends"].cast(pa.int32())).filter(shared)
        return pa.ListArray.from_arrays(pa.array(np.append(0, upto.to_numpy()), pa.int32()), values)

    flat = {"a": a.flatten(), "b": b.flatten()}
    ends = np.cumsum(np.bincount(links["doc"].filter(shared).to_numpy(), minlength=rows))
    offsets = pa.array(np.append(0, ends), pa.int32())
    if sides is None:
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([cut(c, flat[c]) for c in "ab"], ["a", "b"]))
    texts = [pc.binary_join(cut(c, side.numbers.take(flat[c])), ",") for c, side in zip("ab", sides)]
    return pc.binary_join(pa.ListArray.from_arrays(offsets, pc.binary_join_element_wise(*texts, "|")), ";")


def align_texts(rows: DataFrame, a_file: str, b_file: str, as_text: bool = False, *, block_bytes: int = 1 << 20) -> DataFrame:
    """For each (row, key, text) its NUMBERS, its groups, and its distinct pairs as lists of A ids, B ids and times."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sides = encoder_of(a_file, b_file), sides_of(a_file, b_file)
        for batch in batches:
            for start, end in blocks_of(batch["text"], block_bytes):
                part = batch.slice(start, end - start)
                texts = part["text"].to_pylist()
                wanted = pa.array([(" " + t).encode() if t else None for t in texts], pa.binary())
                ids = encoder.encode(texts)
                same = [pc.equal(side.bytes_of(i), wanted) for side, i in zip(sides, ids)]
                valid = pc.fill_null(pc.and_(*same), False)
                if not pc.all(valid).as_py():
                    ids = [pc.if_else(valid, i, pa.scalar([], i.type)) for i in ids]
                yield aligned(part, *ids, sides)

    def aligned(part: pa.RecordBatch, a: pa.ListArray, b: pa.ListArray, sides: tuple[Tokens, Tokens]) -> pa.RecordBatch:
        n = part.num_rows
        links = overlaps(a, b, sides)
        per_row = lambda docs: pa.array(np.bincount(docs.to_numpy(), minlength=n), pa.int64())
        pairs = pairs_of(links)
        pairs = pairs.take(pc.array_sort_indices(pairs["doc"].combine_chunks()))
        offsets = pa.array(np.append(0, np.cumsum(np.bincount(pairs["doc"].to_numpy(), minlength=n))), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, x.combine_chunks().cast(pa.int32()))
                 for x in (pc.divide(pairs["pair"], PAIR), pc.bit_wise_and(pairs["pair"], PAIR - 1), pairs["times"])]
        numbers = [*(pc.list_value_length(x).cast(pa.int64()) for x in (a, b)),
                   per_row(links["doc"].filter(pc.and_(links["a_ends"], links["b_ends"]))), per_row(links["doc"])]
        groups = groups_of(a, b, links, n, sides if as_text else None)
        return pa.RecordBatch.from_arrays([part["row"], part["key"], *numbers, groups, *lists], ["row", "key", *NUMBERS, "groups", *LISTS])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(align, f"row long, key {kind}, {', '.join(f'{c} long' for c in NUMBERS)}, groups {'string' if as_text else GROUPS}, "
                                  f"{', '.join(f'{c} array<int>' for c in LISTS)}")


def flat_pairs(batch: pa.RecordBatch) -> pa.Array:
    a, b = (batch[c].flatten().cast(pa.int64()) for c in LISTS[:2])
    return pc.add(pc.multiply(a, PAIR), b)


def pair_counts(aligned: DataFrame, *, flush: int = 1 << 20) -> DataFrame:
    """pair, n (documents that hold it linked) and best (whether n is the highest of its A id)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])

        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                # a document lists a pair once
                pairs = pa.table({"pair": flat_pairs(batch.slice(start, 500))})
                held.append(pairs.group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"]))
                if sum(t.num_rows for t in held) > flush:
                    held = [merged()]
                    if held[0].num_rows > flush // 2:
                        yield from held.pop().to_batches()
        if held:
            yield from merged().to_batches()

    counts = written(aligned.select(*LISTS[:2]).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    of_a = F.expr(f"pair div {PAIR}")
    # a row for each id of A's vocabulary
    most = F.broadcast(counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("most")))
    return written(counts.join(most, of_a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def link_sums(aligned: DataFrame, pairs: DataFrame, *, head_size: int = 1 << 19) -> DataFrame:
    """row, n_best and count_sum: links whose pair is in as many documents as any of its A id, and the documents of all links."""
    # head_size rows of 17 bytes
    top = frequent(pairs, head_size).toArrow()
    head = aligned.sparkSession.sparkContext.broadcast(tuple(top[c].to_numpy() for c in ("pair", "n", "best")))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document with what the head gives, and one for each other pair of it."""
        pair, n, best = head.value
        common = pa.table({"pair": pair, "n": n, "best": best.astype(np.int64)})
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                yield from row_sums(batch.slice(start, 500), common)

    def row_sums(part: pa.RecordBatch, common: pa.Table) -> Iterator[pa.RecordBatch]:
        own = pa.table({"doc": pc.list_parent_indices(part["times"]), "pair": flat_pairs(part), "times": part["times"].flatten().cast(pa.int64())})
        joined = own.join(common, "pair", join_type="left outer", use_threads=False)
        found, rest = joined.filter(joined["n"].is_valid()), joined.filter(joined["n"].is_null())
        totals = np.zeros((2, part.num_rows), np.int64)
        times = found["times"].to_numpy()
        for total, value in zip(totals, ("best", "n")):
            np.add.at(total, found["doc"].to_numpy(), found[value].to_numpy() * times)
        names = ["row", "pair", "times", "n_best", "count_sum"]
        # no pair is like a document's own, and no other row has it
        yield pa.RecordBatch.from_arrays([part["row"], pc.subtract(-1, part["row"]), pa.array(np.zeros(part.num_rows, np.int64)), *map(pa.array, totals)], names)
        zeros = pa.array(np.zeros(rest.num_rows, np.int64))
        row = part["row"].take(rest["doc"].combine_chunks())
        yield pa.RecordBatch.from_arrays([row, rest["pair"].combine_chunks(), rest["times"].combine_chunks(), zeros, zeros], names)

    made = aligned.select("row", *LISTS).mapInArrow(sums, "row long, pair long, times long, n_best long, count_sum long")
    best = F.col("n_best") + F.when(F.col("best"), F.col("times")).otherwise(0)
    total = F.col("count_sum") + F.coalesce(F.col("times") * F.col("n"), F.lit(0))
    return made.join(pairs, "pair", "left").groupBy("row").agg(F.sum(best).alias("n_best"), F.sum(total).alias("count_sum"))


def align(docs: DataFrame, a_file: str, b_file: str, key: str = "doc_id", text: str = "text", *, head_size: int = 1 << 19,
          as_text: bool = False, carry: Callable[[Column], Column] = lambda groups: groups) -> DataFrame:
    """For each row its key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups (a list of the lists a and b,
    or with ``as_text`` a text like ``a1,a2|b1;a3|b2``).

    ``n_best`` are the links whose pair is in as many documents as any pair of its A id, ``count_sum`` the documents of
    their pairs, summed over links. ``carry`` turns groups into what is to be kept of them, before rows are written.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    aligned = written(align_texts(rows, a_file, b_file, as_text).withColumn("groups", carry(F.col("groups"))), "aligned")
    sums = link_sums(aligned, pair_counts(aligned), head_size=head_size)
    found = aligned.select("row", "key", *NUMBERS, "groups").join(sums, "row")
    return found.select(F.col("key").alias(key), *NUMBERS, "n_best", "count_sum", "groups")
