"""Each stage of the pipeline on a small table against a plain version of it."""

import zlib

import corpus_pipeline as P
import numpy as np
import public_tokenizers
import pytest
from cases import documents, mixed_rows
from test_llm_decontamination import brute as hits
from test_llm_mixing import brute as shares
from test_llm_simhash import classes, fingerprint
from tokenizers import Tokenizer

from tracefold.llm import language_id, queries

ITEMS = [(1, "p3 p4 p5 p6 p7 p8 p9 p10 p11 p12 p13 p14"), (2, "w1 w1 w2"), (None, None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = [r for r in mixed_rows(n=50) if r[0] is not None]
    docs = documents(spark, rows)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def rows_of(df):
    return sorted([(r.doc_id, r.text, r.lang, r.source) for r in df.collect()], key=str)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(P.STAGES)
    assert list(stages) == ["language_id", "simhash_dedup", "decontamination", "mixing", "token_files"]

    kept = stages["language_id"](spark, docs, folder)
    model = language_id.train(language_id.learning_rows(docs))
    wanted = [r for r in rows_of(docs) if language_id.identify(r[1], model.coders(), model.block_bytes, model.min_margin)[2]]
    assert rows_of(kept) == wanted and kept.columns == docs.columns
    assert not {100, 101, 102} & {r[0] for r in wanted}

    kept = stages["simhash_dedup"](spark, docs, folder)
    rows = rows_of(docs)
    least: dict = {}
    for row, c in zip(rows, classes([fingerprint(r[1]) for r in rows])):
        least[c] = min(least.get(c, row), row, key=lambda r: r[0])
    assert [r[0] for r in rows_of(kept)] == [r[0] for r in sorted(least.values(), key=str)] and kept.columns == docs.columns

    kept = stages["decontamination"](spark, docs, folder)
    dirty = {k[1] for k, _, n, _ in hits(rows, ITEMS, 10) if n}
    assert dirty and rows_of(kept) == [r for r in rows if r[0] not in dirty] and kept.columns == docs.columns

    kept = stages["mixing"](spark, docs, folder)
    assert kept.columns == docs.columns and kept.count() < docs.count()

    found = sorted(stages["token_files"](spark, docs, folder).collect(), key=lambda r: r.start)
    tokenizer, at = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    digests = sorted((k, len(ids) + 1, zlib.crc32(np.array([*ids, 0], "<u4").tobytes()))
                     for k, t, *_ in rows for ids in [tokenizer.encode(t or "", add_special_tokens=False).ids])
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == digests
    for r in found:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in found] == sorted(r.doc_id for r in found)


def test_mixing_takes_the_stated_shares(spark, folder, monkeypatch):
    """With the tree of the shares' test in place of the pipeline's."""
    from test_llm_mixing import groups

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    monkeypatch.setattr(queries, "mix_groups", groups)
    kept = dict(P.STAGES)["mixing"](spark, docs, folder)
    wanted = [k[1] for k, _, _ in shares(rows_of(docs), queries.MIX_WEIGHTS, 90, 1)]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(wanted)


def test_run(spark, folder):
    found = P.run(spark, folder)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and found.count() > 0
