"""BPE by pair occurrences against the tokenizers library."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import documents, mixed_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tracefold.llm import pair_index_bpe as B
from tracefold.llm import queries

WORDS = public_tokenizers.path("word_bpe_49k.json")


def odd_texts(n=400):
    rng = random.Random(11)
    letters = [*" \n\t\x0b\x0caAé.,1'sé漢\x1c\x85\xa0　 éİΣσß½²̈́가\U0001f600\x00", "<|endoftext|>", "<|startoftext|>",
               "<|end", "the ", "'LL", "'s", "'re", "\r\n", "aaaaaaa", "hahaha", "......"]
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(n)]


def ids_of(encoder, texts):
    ids, ends = encoder.encode(texts)
    return [x.tolist() for x in np.split(ids, ends)[:-1]]


def test_encoder_is_the_tokenizer():
    tokenizer, encoder = Tokenizer.from_file(WORDS), B.PairIndexEncoder(WORDS)
    texts = [*odd_texts(), *(t or "" for _, t, *_ in mixed_rows()), ""]
    found = ids_of(encoder, texts)
    assert found == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    decoded = encoder.decode(pa.array(found, pa.list_(pa.int32()))).to_pylist()
    assert decoded == [tokenizer.decode(ids, skip_special_tokens=False) for ids in found]


def test_every_character_alone():
    """Normalisation and classes of all characters, between letters and on their own."""
    tokenizer, encoder = Tokenizer.from_file(WORDS), B.PairIndexEncoder(WORDS)
    codes = [c for c in range(0x3400) if not 0xD800 <= c < 0xE000] + list(range(0x1F100, 0x1F700, 7))
    texts = ["".join(f"a{chr(c)}b {chr(c)} " for c in codes[k:k + 64]) for k in range(0, len(codes), 64)]
    assert ids_of(encoder, texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_no_texts():
    encoder = B.PairIndexEncoder(WORDS)
    assert ids_of(encoder, []) == [] and ids_of(encoder, [None, "", " \n"]) == [[], [], []]
    assert encoder.decode(pa.array([[], [3, 999_999, -1, 4]], pa.list_(pa.int32()))).to_pylist() == ["", "$ %"]


def small_file(path, merges):
    letters = "abc"
    vocab = [*letters, *(c + "</w>" for c in letters), *(a + b for a, b in merges)]
    stored = json.load(open(WORDS))
    stored["model"] |= {"vocab": {t: k for k, t in enumerate(vocab)}, "merges": merges}
    stored["added_tokens"] = []
    path.write_text(json.dumps(stored))
    return str(path)


def test_overlapping_pairs(tmp_path):
    """Runs of one letter, and pairs that take each other's symbols."""
    merges = [["a", "a"], ["aa", "aa"], ["a", "b"], ["aa", "a</w>"], ["b", "aa"], ["ab", "ab"], ["ba", "b"], ["aaaa", "aaaa"], ["b", "a"]]
    with pytest.raises(ValueError, match="ranks before"):
        B.PairIndexEncoder(small_file(tmp_path / "bad.json", merges))
    merges.insert(6, merges.pop())
    file = small_file(tmp_path / "good.json", merges)
    tokenizer, encoder, rng = Tokenizer.from_file(file), B.PairIndexEncoder(file), random.Random(2)
    texts = [" ".join("".join(rng.choice("aaab") for _ in range(rng.randrange(1, 30))) for _ in range(8)) for _ in range(200)]
    assert ids_of(encoder, texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_vocabularies_without_word_ends_are_refused():
    with pytest.raises(ValueError, match="word ends"):
        B.PairIndexEncoder(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("block_bytes", [1, 200, 1 << 20])
def test_whole_tables(spark, block_bytes):
    rows = [*mixed_rows(), *((300 + k, t) for k, t in enumerate(odd_texts(60)))]
    tokenizer = Tokenizer.from_file(WORDS)
    encoded = B.encode_texts(documents(spark, rows), WORDS, block_bytes=block_bytes)
    found = encoded.withColumn("text", B.decode_ids(F.col("ids"), WORDS, block_ids=block_bytes)).collect()
    wanted = [(k, tokenizer.encode(t or "", add_special_tokens=False).ids) for k, t, *_ in rows]
    assert sorted(((r.doc_id, list(r.ids), r.text) for r in found), key=str) == sorted(
        ((k, ids, tokenizer.decode(ids, skip_special_tokens=False)) for k, ids in wanted), key=str)
    assert B.encode_texts(documents(spark, rows).limit(0), WORDS).count() == 0


def test_query(spark, tmp_path):
    rows = [*mixed_rows(), *((300 + k, t) for k, t in enumerate(odd_texts(60)))]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer, sha = Tokenizer.from_file(WORDS), lambda t: hashlib.sha256(t.encode()).hexdigest()
    wanted = []
    for k, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        wanted.append((k, len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))))
    found = queries.op12_pair_index_bpe(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)
