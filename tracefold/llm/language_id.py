"""Language identification by compression.

Each language has a raw-content dictionary for zstandard, made of pieces of labelled texts. A text
is cut into blocks, every block is compressed with every dictionary, and the language whose blocks
take the fewest bytes wins. The margin between the two smallest totals says how sure that is; texts
with a narrow margin are rejected.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and is rejected. Equal
totals go to the language with more labelled rows, then to the smaller name; they have margin 0.
Repeated rows get equal results. With no labelled rows every text is ``und``. Columns of the input
named like a result column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
RESULT = "lang_pred string, score double, accepted boolean"


@dataclass(frozen=True)
class LanguageModel:
    """Dictionaries in order of preference between equal totals."""

    dictionaries: tuple[tuple[str, bytes], ...]
    level: int = 6
    block_bytes: int = 4096
    min_margin: float = 0.002

    def coders(self) -> list[tuple[str, zstandard.ZstdCompressor]]:
        made = []
        for lang, content in self.dictionaries:
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=self.level)
            made.append((lang, zstandard.ZstdCompressor(
                level=self.level, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)))
        return made


def pieces(texts: list[str], size: int, total: int) -> bytes:
    """Up to ``total`` bytes: the first piece of every text, then the second of every text, and so on."""
    folded = [t.lower().encode() for t in texts]
    taken, used, start = [], 0, 0
    while used < total and any(start < len(b) for b in folded):
        for b in folded:
            piece = b[start:start + size]
            taken.append(piece)
            used += len(piece)
        start += size
    return b"".join(taken)[:total]


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", *, rows_per_language: int = 128,
          dictionary_bytes: int = 65536, piece_bytes: int = 1024, max_languages: int = 256, **options) -> LanguageModel:
    """A model from a sample of at most ``rows_per_language`` labelled rows for each language.

    The sample is bounded: the rows with the smallest hashes of their key. ``labelled`` may have
    more rows than that by any factor; rows with a null label, text or key are left out.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(key).alias("key"), F.col(text).alias("text")).dropna()
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(max_languages + 1).collect()}
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key")
    picked = (rows.select("lang", "key").withColumn("at", F.row_number().over(by_hash))
              .filter(F.col("at") <= rows_per_language).select("lang", "key").distinct())
    # rows_per_language * max_languages rows at most
    texts: dict[str, list[tuple[str, str]]] = {}
    for r in rows.join(F.broadcast(picked), ["lang", "key"]).dropDuplicates(["lang", "key"]).collect():
        texts.setdefault(r.lang, []).append((str(r.key), r.text))
    return LanguageModel(tuple(
        (name, pieces([t for _, t in sorted(texts[name])], piece_bytes, dictionary_bytes))
        for name in sorted(texts, key=lambda n: (-counts[n], n))), **options)


def identify(text: str | None, coders, block_bytes: int, min_margin: float) -> tuple[str, float, bool]:
    if not coders or text is None or not LETTER.search(text):
        return UNKNOWN, 0.0, False
    data = text.lower().encode()
    blocks = [data[k:k + block_bytes] for k in range(0, len(data), block_bytes)]
    totals = [sum(len(coder.compress(b)) for b in blocks) for _, coder in coders]
    best = min(range(len(totals)), key=totals.__getitem__)
    others = totals[:best] + totals[best + 1:]
    score = 1 - totals[best] / min(others) if others else 1.0
    return coders[best][0], score, score >= min_margin


def language_of(text: Column, model: LanguageModel) -> Column:
    """A struct of lang_pred, score (0 to 1) and accepted for a text column."""

    @F.arrow_udf(RESULT)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coders = model.coders()
        for batch in batches:
            found = [identify(t.as_py(), coders, model.block_bytes, model.min_margin) for t in batch]
            yield pa.StructArray.from_arrays(
                [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))],
                ["lang_pred", "score", "accepted"])

    return predict(text)


def identify_languages(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and accepted."""
    found = docs.withColumn("_language", language_of(F.col(text), model))
    return found.withColumns({c: F.col(f"_language.{c}") for c in ("lang_pred", "score", "accepted")}).drop("_language")


def fold_of(key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo 4; null for a null key."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4))


def learning_rows(docs: DataFrame) -> DataFrame:
    """Rows with a label whose fold is not the held-out one; a row without doc_id is never learned from."""
    return docs.filter((fold_of() != 2) & F.col("lang").isNotNull())
