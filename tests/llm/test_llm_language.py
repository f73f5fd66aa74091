import random
import struct
import zlib

import pytest
import xxhash
import zstandard
from cases import documents, mixed_rows
from pyspark.sql import functions as F

from tracefold.llm import language_id as L

SF_DIR = "/root/testdata/sf0.001"


def predictions(df):
    return {r.doc_id: (r.lang_pred, r.score, r.accepted) for r in df.collect()}


def test_held_out_accuracy_and_what_is_learned_from(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = L.train(L.learning_rows(docs))
    found = L.identify_languages(docs, model).withColumn("held", L.fold_of() == 2).cache()
    held = found.filter("held").collect()
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in held)
    # labels, sources and held-out texts change nothing
    other = docs.withColumns({"lang": F.when(L.fold_of() == 2, "xx").otherwise(F.col("lang")), "source": F.lit("s"),
                              "text": F.when(L.fold_of() == 2, F.reverse("text")).otherwise(F.col("text"))})
    assert L.train(L.learning_rows(other)) == model


def test_defined_cases(spark):
    docs = documents(spark, [*mixed_rows(), (200, "1234 !!", "en", "s"), (201, "mot le la des", "fr", "s")])
    model = L.train(L.learning_rows(docs))
    found = L.identify_languages(docs, model)
    assert found.columns == [*[c for c in docs.columns if c not in ("lang_pred", "score", "accepted")], "lang_pred", "score", "accepted"] \
        or set(found.columns) == {*docs.columns, "accepted"}
    by_id = predictions(found)
    for k in (100, 101, 102, 200):
        assert by_id[k] == ("und", 0.0, False)
    assert found.filter("doc_id = 103").select("text", "lang_pred", "score").distinct().count() == 2
    nothing = L.train(docs.limit(0))
    assert {p[0] for p in predictions(L.identify_languages(docs, nothing)).values()} == {"und"}
    assert L.identify_languages(docs.limit(0), model).count() == 0


def plainly(learned, texts, rows_each=128, held=65536, piece=1024, block=4096, margin=0.002):
    """(language, score, accepted) of each text, told from the definition; ``learned`` holds (doc_id, lang, text)."""
    def place(key):
        digest = xxhash.xxh64(struct.pack("<q", key), seed=42).intdigest()
        return digest - 2**64 if digest >= 2**63 else digest, key
    by_lang = {}
    for key, lang, text in learned:
        if None not in (key, lang, text):
            by_lang.setdefault(lang, []).append((key, text))
    sizes = {}
    for lang, rows in sorted(by_lang.items(), key=lambda item: (-len(item[1]), item[0])):
        sample = sorted(sorted(rows, key=lambda r: place(r[0]))[:rows_each], key=lambda r: str(r[0]))
        folded, content = [t.lower().encode() for _, t in sample], b""
        for start in range(0, max(map(len, folded)), piece):
            if len(content) < held:
                content += b"".join(b[start:start + piece] for b in folded)
        dictionary = zstandard.ZstdCompressionDict(content[:held], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=6)
        coder = zstandard.ZstdCompressor(level=6, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes[lang] = lambda data, coder=coder: sum(len(coder.compress(data[k:k + block])) for k in range(0, len(data), block))
    for text in texts:
        if text is None or not any(c.isalpha() for c in text):
            yield "und", 0.0, False
            continue
        totals = [(size(text.lower().encode()), k, lang) for k, (lang, size) in enumerate(sizes.items())]
        (least, _, lang), (following, _, _) = sorted(totals)[:2]
        yield lang, 1 - least / following, 1 - least / following >= margin


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_every_document_as_told_from_the_definition(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    rows = docs.select("doc_id", "lang", "text").collect()
    learned = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    found = predictions(L.identify_languages(docs, L.train(L.learning_rows(docs))))
    expected = dict(zip((r.doc_id for r in rows), plainly(learned, (r.text for r in rows))))
    assert found == expected


def test_whole_texts_count():
    rng = random.Random(1)
    a, b = (" ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(900)) for letters in ("abcdefg", "tuvwxyz"))
    model = L.LanguageModel((("a", a.encode()), ("b", b.encode())))
    text = a[:2000] + b * 3
    assert L.identify(text, model.coders(), model.block_bytes, model.min_margin)[0] == "b"
    one = L.LanguageModel((("a", a.encode()),))
    assert L.identify("x", one.coders(), 4096, 0.002) == ("a", 1.0, True)
