import random
from collections import defaultdict

import pytest
from cases import documents, mixed_rows

from tracefold.llm.line_dedup import LineRuns, dedup_lines


def brute(rows, min_documents):
    strip = lambda x: x.strip(" \t\n\v\f\r")
    low = lambda x: x.encode().lower().decode()
    keyed = lambda line: low(strip(line)) if len(strip(line)) >= 40 else None
    holders = defaultdict(list)
    for k, text, *_ in rows:
        for key in {keyed(line) for line in (text or "").split("\n")} - {None}:
            holders[key].append(k)
    gone = {key: max((k for k in ks if k is not None), default=None) for key, ks in holders.items() if len(ks) >= min_documents}
    out = []
    for k, text, *_ in rows:
        lines = (text or "").split("\n")
        stay = [line for line in lines if keyed(line) not in gone or gone[keyed(line)] == k]
        out.append(((k is None, k or 0), len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out)


def lined_rows():
    rng = random.Random(4)
    shared = [f"Shared line number {k} with more than forty code points é" for k in range(6)] + ["é" * 40, "é" * 39, "short"]
    made = []
    for k in range(50):
        lines = [rng.choice(shared + ["  " + shared[0].upper().replace("É", "é") + "\t"]) for _ in range(rng.randrange(6))] + [f"own line {k} " + "z" * 40]
        rng.shuffle(lines)
        made.append((400 + k, "\n".join(lines), "en", "s"))
    nobody = [(None, "a line that only documents without an id hold, many times", "en", "s")] * 6
    return [*mixed_rows(), *made, made[-1], *nobody]


@pytest.mark.parametrize("batches, min_documents", [(1, 5), (3, 5), (5, 2)])
def test_lines(spark, batches, min_documents):
    rows = lined_rows()
    found = dedup_lines(documents(spark, rows), batches=batches, min_documents=min_documents)
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_lines, r.n_dropped, r.text) for r in found.collect()) == brute(rows, min_documents)


def test_empty_table(spark):
    assert dedup_lines(documents(spark, mixed_rows()).limit(0)).count() == 0


def test_no_run_stays_in_the_catalog(spark):
    before = {t.name for t in spark.catalog.listTables()}
    found = dedup_lines(documents(spark, lined_rows()))
    assert {t.name for t in spark.catalog.listTables()} == before
    assert found.count() == len(lined_rows())


def test_runs_are_levelled_and_joined_without_moving(spark):
    store = LineRuns(spark)
    for k in range(5):
        batch = spark.createDataFrame([(100 - 10 * k - j, j % 3, k % 2) for j in range(6)], "doc_id long, hi long, lo long")
        run = store.add(batch)
    assert [len(level) for level in store.levels] == [1, 0, 1]
    assert {r.keeper for r in run.collect()} == {None}  # all keys were seen before
    merged = {(r.hi, r.lo): (r.n, r.keeper) for r in store.merged().collect()}
    assert merged == {(h, lo): (6 if lo == 0 else 4, (100 if lo == 0 else 90) - h) for h in range(3) for lo in range(2)}
    plan = store.merged()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
