import hashlib
import math
from collections import defaultdict

import pytest
from cases import documents, mixed_rows
from pyspark.sql import functions as F

from tracefold.llm.mixing import mix


def groups():
    return {"domain": F.when(F.col("source") == "src0", "web").otherwise("rest"), "lang": F.col("lang"), "source": F.col("source")}


def brute(rows, weights, percent, epochs, seed=17):
    """doc_id, epoch, taken by a recursive fill and one sort for each leaf."""
    leaves = defaultdict(list)
    for k, text, lang, source in rows:
        n = len((text or "").encode().split())
        if n:
            leaves["web" if source == "src0" else "rest", lang, source].append((k, n))
    total = sum(n for docs in leaves.values() for _, n in docs)
    # a leaf under any weight of 0 can take nothing
    held = {leaf: sum(n for _, n in docs) for leaf, docs in leaves.items()
            if all(weights.get(level, {}).get(value, 1) for level, value in zip(("domain", "lang", "source"), leaf))}

    def fill(prefix, given):
        depth = len(prefix)
        if depth == 3:
            return {prefix: given}
        caps = defaultdict(int)
        for leaf, n in held.items():
            if leaf[:depth] == prefix:
                caps[leaf[depth]] += n * epochs
        weight = {c: weights.get(("domain", "lang", "source")[depth], {}).get(c, 1) for c in caps}
        tag = lambda c: "-" if c is None else f"={c}"
        order, out, left = sorted(caps, key=lambda c: (caps[c] / weight[c], tag(c))), {}, given
        for k, c in enumerate(order):
            total = sum(weight[x] for x in order[k:])
            if caps[c] * total > left * weight[c]:
                out |= {x: left * weight[x] // total for x in order[k:]}
                break
            out[c] = caps[c]
            left -= caps[c]
        return {leaf: n for c, g in out.items() for leaf, n in fill((*prefix, c), g).items()}

    result = []
    for leaf, tokens in fill((), total * percent // 100).items():
        full, rest = divmod(tokens, held[leaf])
        result += [(k, e, n) for e in range(full) for k, n in leaves[leaf]]
        units = defaultdict(list)
        for k, n in leaves[leaf]:
            units[hashlib.md5(f"{seed}:{full}:{'-' if k is None else k}".encode()).hexdigest()].append((k, n))
        for place in sorted(units):
            size = sum(n for _, n in units[place])
            result += [(k, full, n if size <= rest else rest * n // size) for k, n in units[place]]
            rest -= min(rest, size)
    return sorted(((k is None, k or 0), e, n) for k, e, n in result if n)


@pytest.mark.parametrize("weights, percent, epochs", [
    ({}, 100, 4), ({"domain": {"web": 9}, "lang": {"en": 1, "de": 5}}, 60, 1), ({"source": {"src0": 0}}, 100, 2),
    ({"source": {"src0": 0, "src1": 0}, "lang": {"de": 0, "en": 3}}, 100, 3), ({"domain": {"web": 0}}, 50, 2), ({"domain": {"web": 0, "rest": 0}}, 50, 2), ({}, 900, 2), ({}, 0, 1)])
def test_shares(spark, weights, percent, epochs):
    rows = mixed_rows()
    found = mix(documents(spark, rows), groups(), weights, budget_percent=percent, max_epochs=epochs).select("doc.doc_id", "epoch", "take_tokens").collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.epoch, r.take_tokens) for r in found if r.take_tokens) == brute(rows, weights, percent, epochs)


def test_weight_0_leaves_its_part_to_other_domains(spark):
    rows = [(k, " ".join(["w"] * 10), "en", source) for k, source in enumerate(["src0"] * 10 + ["src1"] * 10 + ["src2"] * 20)]
    by = {"domain": F.when(F.col("source") == "src2", "b").otherwise("a"), "source": F.col("source")}
    taken = mix(documents(spark, rows), by, {"source": {"src0": 0, "src1": 0}}, budget_percent=50, max_epochs=2).agg(F.sum("take_tokens")).first()[0]
    assert taken == 200


def test_rows_stay_whole_and_empty_tables(spark):
    docs = documents(spark, mixed_rows())
    assert mix(docs, groups(), {}).select("doc.*").dtypes == docs.dtypes
    assert mix(docs.limit(0), groups(), {}).count() == 0
    taken = mix(docs, groups(), {}, budget_percent=50, max_epochs=1).agg(F.sum("take_tokens")).first()[0]
    total = mix(docs, groups(), {}, budget_percent=100, max_epochs=1).agg(F.sum("take_tokens")).first()[0]
    assert math.isclose(taken, total / 2, rel_tol=0.01)
