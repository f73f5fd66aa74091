"""Token counts without token ids.

A text is cut into pre-tokens at places that no piece of the vocabulary crosses: before a run of
spaces and around a line end. Pieces are counted once for every distinct pre-token of the corpus;
a document's count is the sum over its pre-token frequencies.

The pre-tokens with the highest frequencies, ``head_size`` of them at most, are sent to all tasks,
so that a very common one is never joined. The others are joined with their counts by shuffle.

Defined cases: a null or empty text has no bytes and no tokens. Rows are kept apart even when equal.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracefold.llm.common import byte_length, written

SPACE = "▁"
# a run of spaces goes with what follows it; a line end stands alone
PRE_TOKEN = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


def pre_tokens(text: str) -> list[str]:
    """The normalised text, in parts that are encoded independently."""
    return PRE_TOKEN.findall(SPACE + text.replace(" ", SPACE)) if text else []


class PieceCounter:
    """Counts the pieces of one pre-token, its leading space mark included."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.before_line = len(self.model.encode("\n"))

    def count(self, tokens: list[str]) -> list[int]:
        """The processor puts a space mark before every text: one of ours is left out, or a line end put in front."""
        shown = [t[1:] if t[0] == SPACE else "\n" + t for t in tokens]
        found = self.model.encode(shown, num_threads=1)
        # a mark alone becomes an empty text, for which the processor has no piece
        return [len(ids) - (0 if t[0] == SPACE else self.before_line) if t != SPACE else 1
                for t, ids in zip(tokens, found)]


def frequencies(batches: Iterator[pa.RecordBatch], flush: int = 500_000) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["token", "n"])

    for batch in batches:
        for text in batch.column(0):
            if text.is_valid:
                seen.update(pre_tokens(text.as_py()))
            if len(seen) > flush:
                yield out()
                seen.clear()
    yield out()


def vocabulary(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """token, n (occurrences in the corpus), pieces; one row for each distinct pre-token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(model_file)
        for batch in batches:
            tokens = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counter.count(tokens), pa.int64())], ["token", "n", "pieces"])

    distinct = (docs.select(text).mapInArrow(frequencies, "token string, n long")
                .groupBy("token").agg(F.sum("n").alias("n")))
    return distinct.mapInArrow(count, "token string, n long, pieces long")


def frequent(words: DataFrame, head_size: int) -> DataFrame:
    """The pre-tokens above a frequency that at most ``head_size`` of them reach."""
    step = F.floor(F.log2("n") * 16).cast("int")
    # some hundred steps whatever the corpus is
    steps = sorted(((r.step, r.tokens) for r in words.groupBy(step.alias("step")).agg(F.count("*").alias("tokens")).collect()), reverse=True)
    least, held = None, 0
    for at, tokens in steps:
        held += tokens
        if held > head_size:
            break
        least = at
    return words.filter(step >= least) if least is not None else words.limit(0)


def count_tokens(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text", *, head_size: int = 1 << 19) -> DataFrame:
    """key, n_bytes, n_tokens for each row of ``docs``."""
    words = written(vocabulary(docs, model_file, text), "pretokens")
    # head_size rows of some 20 bytes
    top = frequent(words, head_size).select("token", "pieces").toArrow()
    head = docs.sparkSession.sparkContext.broadcast((top["token"].to_pylist(), top["pieces"].to_pylist()))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text"),
                       byte_length(F.col(text)).alias("bytes"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document with what the head gives, and one for each other pre-token of it."""
        known = dict(zip(*head.value))
        for batch in batches:
            take, tokens, times, own = [], [], [], []
            for k, (row, text) in enumerate(zip(batch["row"].to_pylist(), batch["text"])):
                total, before = 0, len(tokens)
                # a line end stands alone, so no pre-token is like this one, and no other row has it
                tokens.append(f"\n{row}")
                times.append(0)
                for t, n in Counter(pre_tokens(text.as_py() or "")).items():
                    pieces = known.get(t)
                    if pieces is None:
                        tokens.append(t)
                        times.append(n)
                    else:
                        total += pieces * n
                own += [total, *[0] * (len(tokens) - before - 1)]
                take += [k] * (len(tokens) - before)
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch[c].take(at) for c in ("row", "key", "bytes")), pa.array(own, pa.int64()), pa.array(tokens, pa.string()),
                 pa.array(times, pa.int64())], ["row", "key", "bytes", "own", "token", "times"])

    kind = rows.schema["key"].dataType.simpleString()
    parts = rows.mapInArrow(sums, f"row long, key {kind}, bytes long, own long, token string, times long")
    tokens = F.col("own") + F.coalesce(F.col("times") * F.col("pieces"), F.lit(0))
    return (parts.join(words.select("token", "pieces"), "token", "left").groupBy("row")
            .agg(F.max("key").alias(key), F.max("bytes").alias("n_bytes"), F.sum(tokens).alias("n_tokens")).drop("row"))
