import re
from collections import Counter, defaultdict

import pytest
from cases import documents, mixed_rows

from tracefold.llm.quality import rate_documents


def normalised(line):
    return re.sub("[0-9]+", "0", re.sub(r"[ \t-\r]+", " ", line.lower()).strip(" "))


def brute(rows, limit):
    lines_of = [[line for line in (t or "").split("\n") if line.encode().split()] for _, t, *_ in rows]
    often = Counter((r[3], n) for r, lines in zip(rows, lines_of) for n in {normalised(line) for line in lines})
    out = []
    for (k, text, _, host), lines in zip(rows, lines_of):
        w = [x.decode() for x in (text or "").encode().split()]
        places = defaultdict(list)
        for i in range(len(w) - 4):
            places[tuple(w[i:i + 5])].append(i)
        repeated = {i + o for at in places.values() if len(at) > 1 for i in at for o in range(5)}
        removed = sum(len(line.encode().split()) for line in lines if often[host, normalised(line)] > limit)
        failed = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
        left = len(w) - removed
        clean = "\n".join(x for x in (text or "").split("\n") if not x.encode().split() or often[host, normalised(x)] <= limit) if text is not None else None
        out.append(((k is None, k or 0), len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
                    len(repeated), removed, failed, not failed and left >= 10 and left >= 0.5 * len(w), clean))
    return sorted(out, key=str)


EXTRA = [(200 + k, f"Menu {k} |  Home\nshared   line of ten words that all of these have\nown {k} words " + " ".join(f"u{k}v{j}" for j in range(20)), "en", h)
         for k, h in enumerate(["a", "a", "a", "b", None, None, None])] + [
    (300, "a b c d e a b c d e f g h i j k l m n o p\n\na b\na b\n a b", "en", "a"), (301, "same line\nsame line\nother # $ line", "en", "b")]


@pytest.mark.parametrize("limit", [1, 2, 50])
def test_rules(spark, limit):
    rows = [*mixed_rows(), *EXTRA]
    found = rate_documents(documents(spark, rows), max_documents=limit, with_text=True)
    got = sorted((((r.doc_id is None, r.doc_id or 0), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_removed, r.base_failed,
                   r.kept, r.clean_text) for r in found.collect()), key=str)
    assert got == brute(rows, limit)
    removed = {r[0][1]: r[6] for r in got}
    assert limit != 2 or (removed[200] > 0 and removed[203] == 0 and removed[204] > 0)


def test_empty_table(spark):
    assert rate_documents(documents(spark, mixed_rows()).limit(0)).count() == 0
