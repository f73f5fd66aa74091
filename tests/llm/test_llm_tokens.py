import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from cases import documents, mixed_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tracefold.cluster import shared_path
from tracefold.llm import token_counts as C
from tracefold.llm import token_files as T
from tracefold.llm.huffman import Code, code_lengths

MODEL, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


def odd_texts(n=300):
    rng = random.Random(5)
    letters = [*" \n\t▁aé.,1'sé漢\x1c\x85\xa0　<", "<s>", "</s>", "<unk>", "<|endoftext|>", "  ", "the ", "'ll", "\r\n", "\x00"]
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_pre_tokens_are_encoded_independently():
    model, counter = sentencepiece.SentencePieceProcessor(model_file=MODEL), C.PieceCounter(MODEL)
    for text in odd_texts():
        assert sum(counter.count(C.pre_tokens(text))) == len(model.encode(text)), repr(text)


@pytest.mark.parametrize("head_size", [0, 40, 1 << 19])
def test_counts(spark, head_size):
    rows = [*mixed_rows(), *((300 + k, t) for k, t in enumerate(odd_texts(80)))]
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = C.count_tokens(documents(spark, rows), MODEL, head_size=head_size).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, r.n_tokens) for r in found) == sorted(
        ((k is None, k or 0), len((t or "").encode()), len(model.encode(t or ""))) for k, t, *_ in rows)


def test_counts_of_an_empty_table(spark):
    assert C.count_tokens(documents(spark, mixed_rows()).limit(0), MODEL).count() == 0


@pytest.mark.parametrize("vocabulary, n", [(1, 5), (2, 300), (50_257, 70_000), (3, 0), (30, 6400)])
def test_huffman_round_trip(vocabulary, n):
    ids = np.minimum(np.random.default_rng(1).zipf(1.3, n) - 1, vocabulary - 1) if n else np.zeros(0, int)
    counts = np.bincount(ids, minlength=vocabulary)
    lengths = code_lengths(counts)
    assert lengths.max(initial=0) <= 18 and sum(2.0 ** -float(x) for x in lengths if x) <= 1
    code = Code(lengths)
    offsets, bits = code.encode(ids)
    assert (code.decode(offsets, bits, n) == ids).all()


def test_huffman_is_optimal_and_limited():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21])
    assert (counts * code_lengths(counts)).sum() == 132  # Fibonacci counts: 7 7 6 5 4 3 2 1
    assert code_lengths(counts, 4).max() == 4


def ids_of(encoder, texts):
    return [np.frombuffer(f, "<u4").tolist() for f in encoder.encode(texts)]


def test_cached_encoder_is_the_tokenizer():
    tokenizer = Tokenizer.from_file(BYTES)
    texts = odd_texts()
    for held in (10, 500_000):
        assert ids_of(T.CachedEncoder(BYTES, held), texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_frequent_parts_are_encoded_once():
    encoder = T.CachedEncoder(BYTES, held=8)
    for k in range(100):
        ids_of(encoder, [f"the rare{k}"])
        assert len(encoder.young) + len(encoder.old) <= 10
    assert encoder.encoded == 101  # and not 200


def test_each_distinct_part_of_a_block_is_looked_up_once(monkeypatch):
    encoder, asked, lookup = T.CachedEncoder(BYTES), [], T.CachedEncoder.lookup
    monkeypatch.setattr(encoder, "lookup", lambda parts: asked.extend(parts) or lookup(encoder, parts))
    ids_of(encoder, ["the the the", None, "", "the the"] * 50)
    assert sorted(asked) == [" the", "the"]


def test_plain_parts_need_no_rules_of_the_tokenizer(monkeypatch):
    tokenizer, encoder = Tokenizer.from_file(BYTES), T.CachedEncoder(BYTES)
    text = "A (small) house, été 漢字。 no. 12a: a--b;x"
    monkeypatch.setattr(encoder, "encode_odd", lambda parts: pytest.fail(f"{parts}"))
    assert ids_of(encoder, [text]) == [tokenizer.encode(text, add_special_tokens=False).ids]


def test_random_characters_are_encoded_as_by_the_tokenizer():
    rng, tokenizer, encoder = random.Random(7), Tokenizer.from_file(BYTES), T.CachedEncoder(BYTES)
    some = [*map(chr, range(0x250)), *(chr(c) for c in range(0x2000, 0x2070)), *" \n'.,a1<|þÿ" * 40]
    anywhere = lambda: chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)]))
    texts = ["".join(rng.choice(some) if rng.random() < 0.8 else anywhere() for _ in range(rng.randrange(60))) for _ in range(2000)]
    texts.append("".join(rng.choice("abc") for _ in range(20_000)))
    assert ids_of(encoder, texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_texts_are_cut_before_white_space():
    texts = [*odd_texts(), "\u3000a\u2003 b\xa0c\u2028", "“a” \u200b\u205f\x85x\x1c y"]
    for kind in (pa.string(), pa.large_string()):
        content, ends = T.content_of(pa.array(["left out", *texts, None], kind)[1:])
        starts = T.part_starts(content, ends).tolist()
        parts = [bytes(content[a:z]).decode() for a, z in zip(starts, [*starts[1:], len(content)])]
        assert parts == [part for t in texts for part in T.PART.findall(t)]


def test_plain_special_strings():
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    texts = odd_texts()
    assert ids_of(T.CachedEncoder(BYTES, plain=True), texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_files(spark):
    rows = [*mixed_rows(), *((300 + k, t) for k, t in enumerate(odd_texts(60)))]
    path = shared_path(spark, "tokens")
    T.write_files(T.encode_documents(documents(spark, rows), BYTES), path)
    found = sorted(T.read_files(spark, path).withColumn("crc", F.crc32("ids")).collect(), key=lambda r: r.start)
    tokenizer = Tokenizer.from_file(BYTES)
    wanted = sorted(((-1 if k is None else k), [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for k, t, *_ in rows)
    got = [((-1 if r.doc_id is None else r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in found]
    assert [k for k, _ in got] == [k for k, _ in wanted]  # by rising id over all files, null first
    assert sorted(got) == wanted
    sizes = [len(i) for _, i in got]
    assert [r.start for r in found] == [sum(sizes[:k]) for k in range(len(sizes))]
    assert all(zlib.crc32(np.array(i, "<u4").tobytes()) == r.crc for (_, i), r in zip(got, found))


def test_files_of_no_documents(spark):
    path = shared_path(spark, "tokens")
    T.write_files(T.encode_documents(documents(spark, mixed_rows()).limit(0), BYTES), path)
    assert T.read_files(spark, path).count() == 0
