"""Ids of many parts of texts in one call of a byte-level BPE tokenizer's model.

The rules that cut a part before its merges cost the library more than the merges. They cut where letters, numbers and
other characters meet, so they are applied to all parts at once, on an array of character kinds; the library itself is
asked for the kind of each character that is met. The parts then stand in the letters of the vocabulary, with the letters
of two bytes that no UTF-8 text has and no merge takes between them, and the model does all merges.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
from tokenizers import Tokenizer, models, pre_tokenizers

LETTER, NUMBER, OTHER, SPACE, ODD = 1, 2, 3, 4, 5
INNER, END = 0xFE, 0xFF
#: Characters in a call of the model: short enough for a processor's cache.
CALL_CHARS = 1024


def byte_letters() -> np.ndarray:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = np.zeros(256, "<u2")
    letters[shown] = shown
    hidden = np.setdiff1d(np.arange(256), shown)
    letters[hidden] = 256 + np.arange(len(hidden))
    return letters


class ByteParts:
    """Plain parts have one space at most, which stands first, and no apostrophe or character that an added token starts with."""

    def __init__(self, tokenizer: Tokenizer):
        vocabulary = tokenizer.get_vocab()
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        self.inner, self.end = vocabulary[chr(INNER)], vocabulary[chr(END)]
        self.letters = byte_letters()
        self.kinds = np.zeros(0x110000, np.uint8)
        self.kinds[ord(" ")] = SPACE
        self.kinds[[ord("'"), *(ord(t.content[0]) for t in tokenizer.get_added_tokens_decoder().values())]] = ODD
        # without rules for cutting
        self.merges = Tokenizer(tokenizer.model)

    @staticmethod
    def fits(tokenizer: Tokenizer) -> bool:
        """Whether the tokenizer has these rules and no others."""
        model, rules, vocabulary = tokenizer.model, tokenizer.pre_tokenizer, tokenizer.get_vocab()
        return (
            isinstance(model, models.BPE) and isinstance(rules, pre_tokenizers.ByteLevel) and rules.use_regex and not rules.add_prefix_space
            and tokenizer.normalizer is None and tokenizer.post_processor is None and tokenizer.truncation is None and tokenizer.padding is None
            and not (model.dropout or model.continuing_subword_prefix or model.end_of_word_suffix or model.ignore_merges or model.byte_fallback)
            and all(chr(c) in vocabulary and not any(chr(c) in token for token in vocabulary if len(token) > 1) for c in (INNER, END)))

    def kinds_of(self, codes: np.ndarray) -> np.ndarray:
        found = self.kinds[codes]
        if not found.all():
            for code in np.unique(codes[found == 0]).tolist():
                together = [kind for kind, other in ((LETTER, "a"), (NUMBER, "1"), (OTHER, ".")) if len(self.split(other + chr(code))) == 1]
                self.kinds[code] = together[0] if together else ODD
            found = self.kinds[codes]
        return found

    def encode(self, parts: list[str]) -> tuple[np.ndarray, list[bytes]]:
        """Whether each part is plain, and the ids of those that are, as little-endian unsigned 32-bit numbers."""
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        kinds = self.kinds_of(np.frombuffer("".join(parts).encode("utf-32-le"), "<u4"))
        starts = np.cumsum(sizes) - sizes
        first = np.zeros(len(kinds), bool)
        first[starts[sizes > 0]] = True
        odd = np.append(0, np.cumsum((kinds == ODD) | ((kinds == SPACE) & ~first)))
        plain = (odd[starts + sizes] == odd[starts]) & (sizes > 0)
        if not plain.all():
            of_plain = np.repeat(plain, sizes)
            kinds, first = kinds[of_plain], first[of_plain]
            parts = [part for part, taken in zip(parts, plain.tolist()) if taken]
        if not parts:
            return plain, []
        cut = first.copy()
        cut[1:] |= (kinds[1:] != kinds[:-1]) & (kinds[:-1] != SPACE)
        return plain, self._merged("".join(parts).encode(), np.flatnonzero(cut), first[cut])

    def _merged(self, text: bytes, cuts: np.ndarray, first: np.ndarray) -> list[bytes]:
        """``cuts``: the characters before which the text is cut, the first one too; ``first``: whether a part starts there."""
        content = np.frombuffer(text, np.uint8)
        places = np.flatnonzero((content & 0xC0) != 0x80)[cuts]
        # a mark before every cut, the one at the start left out, and one behind the last part
        marked = np.full(len(content) + len(places), END, np.uint8)
        is_mark = np.zeros(len(marked), bool)
        marks = places + np.arange(len(places))
        is_mark[marks] = True
        marked[~is_mark] = content
        marked[marks] = np.where(first, END, INNER)
        shown = self.letters[np.append(marked[1:], np.uint8(END))].tobytes().decode("utf-16-le")
        # behind the mark at the end of a part
        ends = np.append(marks[first][1:], len(marked))
        goals = np.arange(CALL_CHARS, len(shown) + CALL_CHARS, CALL_CHARS)
        upto = np.unique(ends[np.minimum(np.searchsorted(ends, goals), len(ends) - 1)]).tolist()
        calls = [shown[a:z] for a, z in zip([0, *upto], upto)]
        found = self.merges.encode_batch_fast(calls, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in found), "<u4")
        is_end = ids == self.end
        kept = ~is_end & (ids != self.inner)
        upto = (np.cumsum(kept)[is_end] * 4).tolist()
        merged = ids[kept].tobytes()
        return [merged[a:z] for a, z in zip([0, *upto], upto)]
