"""BPE encoding with a pair occurrence index, and decoding, for vocabularies that mark word ends.

The distinct pre-tokens of a block of texts stand in one array of symbols, linked to the left and to the
right. An index maps every mergeable pair to all its positions there. Active ranks are taken in ascending
order: a rank is applied to all positions of its pair at once, and the pairs that arise are added to the
lists of their own ranks. A position whose symbols have changed since it was listed is passed over.

Blocks are cut by the bytes of their texts and belong to one partition, so that nothing is shuffled and
a lost task only repeats its own blocks. Every merge must rank after those that make its parts, as learned
vocabularies do; then a rank never becomes active again once it was applied.

Texts are cut at ASCII white space, and each distinct part is normalised and split by the tokenizer's own
rules; special strings in it become their ids. A vocabulary whose pre-tokens can hold white space is refused.

Defined cases: a null or empty text has no ids; decoding no ids, or null, gives an empty text. Ids outside the
vocabulary are left out when decoding. Repeated rows stay apart. A long text is one block.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise
from string import ascii_letters

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracefold.llm.common import blocks_of, take_lists

# what stands between ASCII white space
PART = re.compile(r"[^ \t\n\r\x0b\x0c]+")
GONE = -2  # a symbol that was merged into its left neighbour
NO_RANK = -1


class PairIndexEncoder:
    """Encodes blocks of texts with the vocabulary of a tokenizer file."""

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_file)
        with open(tokenizer_file, encoding="utf-8") as file:
            stored = json.load(file)
        model, added = stored["model"], stored.get("added_tokens") or []
        self.suffix = model.get("end_of_word_suffix")
        if not self.suffix or any(" " in p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str("a b . c")):
            raise ValueError("only vocabularies with word ends, whose pre-tokens hold no white space")
        self.normalize, self.split = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        # ASCII letters are one word, and so is a stop or comma behind them: true of the usual rules, asked of these
        lower = ascii_letters.lower()
        self.plain_words = [w for end in ".," for w, _ in self.split(self.normalize(ascii_letters + end))] == [lower, ".", lower, ","]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in added}
        # the longest of several special strings that start at one place
        self.special_cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.tokens = pa.array(self._texts(vocab | self.special), pa.string())
        self._read_symbols(vocab)
        self._read_merges(vocab, model["merges"])

    @staticmethod
    def _texts(ids: dict[str, int]) -> list[str | None]:
        texts: list[str | None] = [None] * (max(ids.values(), default=-1) + 1)
        for token, k in ids.items():
            texts[k] = token
        return texts

    def _read_symbols(self, vocab: dict[str, int]) -> None:
        """First ids of characters, inside and at the end of a word."""
        letters = [t for t in vocab if len(t) == 1]
        size = max(map(ord, letters)) + 1
        self.inside, self.at_end = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        for c in letters:
            self.inside[ord(c)] = vocab[c]
            self.at_end[ord(c)] = vocab.get(c + self.suffix, -1)

    def _read_merges(self, vocab: dict[str, int], merges: list[list[str]]) -> None:
        """Pairs by rank, and a sorted table from pairs to ranks."""
        parts = [m.split(" ") if isinstance(m, str) else m for m in merges]
        joined = [a + b for a, b in parts]
        made: dict[str, int] = {}
        for rank, token in enumerate(joined):
            made[token] = rank
        if any(made.get(x, -1) >= rank for rank, pair in enumerate(parts) for x in pair):
            raise ValueError("a merge ranks before one that makes a part of it")
        self.left = np.array([vocab[a] for a, _ in parts], np.int64)
        self.right = np.array([vocab[b] for _, b in parts], np.int64)
        self.result = np.array([vocab[t] for t in joined], np.int64)
        self.width = len(vocab) + 1
        keys = self.left * self.width + self.right
        self.rank_of_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of_key]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, NO_RANK where they do not merge."""
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.rank_of_key[at], NO_RANK)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (pre-tokens) one after the other, and where each word's ids end."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        total = int(lengths.sum())
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        ends = np.cumsum(lengths)
        # one more symbol, which merges with nothing, stands left and right of every word
        symbols = np.append(self.inside[codes], -1)
        last = ends[lengths > 0] - 1
        symbols[last] = self.at_end[codes[last]]
        if total and symbols[:-1].min() < 0:
            raise ValueError("a character that the vocabulary does not have")
        after, before = np.arange(1, total + 2), np.arange(-1, total)
        after[last], before[(ends - lengths)[lengths > 0]] = total, total
        self._merge(symbols, before, after, total)
        alive = symbols[:-1] >= 0
        return symbols[:-1][alive], np.append(0, np.cumsum(alive))[ends]

    def _merge(self, symbols: np.ndarray, before: np.ndarray, after: np.ndarray, none: int) -> None:
        """Apply all merges to ``symbols``, which stay at their places; ``none`` is the place of the symbol between words."""
        occurrences: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(places: np.ndarray) -> None:
            """Put places of a pair's left symbol on the list of the pair's rank."""
            ranks = self._ranks(symbols[places], symbols[after[places]])
            places, ranks = places[ranks >= 0], ranks[ranks >= 0]
            if not len(places):
                return
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist()]
            for rank, a, z in zip(ranks[starts].tolist(), starts, [*starts[1:], len(places)]):
                if rank not in occurrences:
                    occurrences[rank] = []
                    heapq.heappush(active, rank)
                occurrences[rank].append(places[a:z])

        add(np.arange(none))
        while active:
            rank = heapq.heappop(active)
            listed = occurrences.pop(rank)
            places = listed[0] if len(listed) == 1 else np.unique(np.concatenate(listed))
            left, right = self.left[rank], self.right[rank]
            places = places[(symbols[places] == left) & (symbols[after[places]] == right)]
            if left == right:
                places = self._apart(places, after)
            if not len(places):
                continue
            taken = after[places]
            following = after[taken]
            symbols[places], symbols[taken] = self.result[rank], GONE
            after[places], before[following] = following, places
            previous = before[places]
            add(np.concatenate([previous[previous != none], places[following != none]]))

    @staticmethod
    def _apart(places: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Every second place of a run in which each pair overlaps the next, from the left."""
        if not len(places):
            return places
        starts = np.append(True, after[places[:-1]] != places[1:])
        within = np.arange(len(places)) - np.flatnonzero(starts)[np.cumsum(starts) - 1]
        return places[within % 2 == 0]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids end."""
        parts = [PART.findall(t) if t else [] for t in texts]
        distinct = {p: k for k, p in enumerate(dict.fromkeys(chain.from_iterable(parts)))}
        words: dict[str, int] = {}
        # a part as words (numbers of zero and more) and special ids (-1 - id)
        pieces, sizes = [], []
        for part in distinct:
            found = self._pieces(part, words)
            pieces += found
            sizes.append(len(found))
        ids, ends = self.encode_words(list(words))
        # special ids stand behind the words
        specials = np.array(sorted(self.special.values()), np.int64)
        ids = np.append(ids, specials)
        ends = np.append(ends, (ends[-1] if len(ends) else 0) + np.arange(1, len(specials) + 1))
        numbers = np.array(pieces, np.int64)
        if len(specials):
            numbers = np.where(numbers >= 0, numbers, len(words) + np.searchsorted(specials, -1 - numbers))
        part_ids, part_ends = take_lists(ids, ends, numbers, np.cumsum(np.array(sizes, np.int64)))
        counts = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        order = np.fromiter(map(distinct.__getitem__, chain.from_iterable(parts)), np.int64, int(counts[-1]) if len(counts) else 0)
        return take_lists(part_ids, part_ends, order, counts)

    def _pieces(self, part: str, words: dict[str, int]) -> list[int]:
        if self.plain_words and part.isascii():
            if part.isalpha():
                return [words.setdefault(part.lower(), len(words))]
            if part[-1] in ".," and part[:-1].isalpha():
                return [words.setdefault(part[:-1].lower(), len(words)), words.setdefault(part[-1], len(words))]
        if self.special_cut is None or not self.special_cut.search(part):
            return [words.setdefault(w, len(words)) for w, _ in self.split(self.normalize(part))]
        found = []
        for piece in self.special_cut.split(part):
            if piece in self.special:
                found.append(-1 - self.special[piece])
            elif piece:
                found += [words.setdefault(w, len(words)) for w, _ in self.split(self.normalize(piece))]
        return found

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The tokens of each list with a space between them."""
        flat = ids.flatten()
        known = pc.if_else(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(self.tokens))), flat, None)
        tokens, parents = self.tokens.take(known), pc.list_parent_indices(ids)
        shown = tokens.is_valid()
        sizes = np.bincount(parents.filter(shown).to_numpy(), minlength=len(ids)) if len(ids) else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), tokens.filter(shown))
        return pc.binary_join(lists, " ")


@lru_cache(maxsize=1)
def encoder_of(tokenizer_file: str) -> PairIndexEncoder:
    """The encoder of a worker process, kept from task to task."""
    return PairIndexEncoder(tokenizer_file)


def encode_texts(docs: DataFrame, tokenizer_file: str, key: str = "doc_id", text: str = "text", *, block_bytes: int = 1 << 20) -> DataFrame:
    """key and ids (array of int) for each row."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_file)
        for batch in batches:
            for a, z in blocks_of(batch["text"], block_bytes):
                ids, ends = encoder.encode(batch["text"].slice(a, z - a).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch["key"].slice(a, z - a), lists], ["key", "ids"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(encode, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode_ids(ids: Column, tokenizer_file: str, *, block_ids: int = 1 << 18) -> Column:
    """The text of a list of ids: its tokens, special ones too, with a space between them."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = encoder_of(tokenizer_file)
        for batch in batches:
            upto = np.cumsum(pc.list_value_length(batch).to_numpy(zero_copy_only=False))
            cuts = np.unique(np.searchsorted(upto, np.arange(block_ids, upto[-1] + 1, block_ids))) if len(batch) else []
            for a, z in pairwise([0, *(int(c) + 1 for c in cuts if c + 1 < len(batch)), len(batch)]):
                yield encoder.decode(batch.slice(a, z - a))

    return decode(F.coalesce(ids, F.array().cast("array<int>")))
