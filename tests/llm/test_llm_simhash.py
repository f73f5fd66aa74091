import random

import numpy as np
import pytest
import xxhash
from cases import documents, mixed_rows

from tracefold.llm import simhash as S
from tracefold.llm.components import connected


def fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[k:k + 4]) for k in range(max(1, len(w) - 3))] if w else []
    votes = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles)) if shingles else 0


def classes(values, budget=4):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    a = np.array(values, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= budget):
            u, v = find(i), find(i + 1 + int(j))
            root[max(u, v)] = min(u, v)
    return [find(k) for k in range(len(a))]


def flipped(rng, value, bits):
    for b in rng.sample(range(64), bits):
        value ^= 1 << b
    return value


def clusters(seed, n):
    rng = random.Random(seed)
    made = [rng.getrandbits(64) for _ in range(n)]
    made += [flipped(rng, rng.choice(made), rng.randrange(1, 7)) for _ in range(n)]
    center = rng.getrandbits(64)
    made += [flipped(rng, center, rng.randrange(1, 4)) for _ in range(n)]
    return sorted(set(made) | {0, 1, (1 << 64) - 1, 1 << 63})


@pytest.mark.parametrize("seed", range(3))
def test_walks_find_every_component(seed):
    values = np.array(clusters(seed, 400), np.uint64)
    forest = S.Forest(len(values))
    for exchange in (False, True):
        given = S.exchanged(values) if exchange else values
        order = np.argsort(given)
        trie = S.TrieWalk(given[order], None, 0, 4, 2)
        forest.join(order, order[trie.run()])
    assert [int(np.flatnonzero(forest.root == r)[0]) for r in forest.root] == classes(values)


def test_links_over_node_pairs(spark):
    values = clusters(7, 150)
    rows = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    links = S.near_links(rows, node_size=16).collect()
    place = {v: k for k, v in enumerate(values)}
    forest = S.Forest(len(values))
    ends = [[place[int(np.int64(x).view(np.uint64))] for x in e] for e in links]
    assert all(bin(values[u] ^ values[v]).count("1") > 0 for u, v in ends)
    forest.join(*(np.array(x) for x in zip(*ends)))
    assert [int(np.flatnonzero(forest.root == r)[0]) for r in forest.root] == classes(values)


def test_components_of_a_long_chain(spark):
    order = list(range(120))
    random.Random(2).shuffle(order)
    links = [*zip(order, order[1:]), (500, 501), (501, 500), (7, 7)]
    found = {r.node: r.root for r in connected(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {**{k: 0 for k in range(1, 120)}, 501: 500}
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_documents(spark):
    rows = [*mixed_rows(n=60), (700, "The SAME words Here and there", "en", "s"), (701, "the same words here and there", "en", "s")]
    values = [fingerprint(t) for _, t, *_ in rows]
    ids = classes(values)
    least = {}
    for (k, *_), c in zip(rows, ids):
        least[c] = min((x for x in (least.get(c), k) if x is not None), default=None)
    found = S.near_duplicates(documents(spark, rows)).collect()
    show = lambda k, f, c: ((k is None, k or 0), f, -1 if c is None else c)
    assert sorted(show(r.doc_id, r.fp % (1 << 64), r.component_id) for r in found) == sorted(show(k, v, least[c]) for (k, *_), v, c in zip(rows, values, ids))
    docs = documents(spark, rows)
    kept = S.drop_near_duplicates(docs)
    assert kept.dtypes == docs.dtypes
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted(-1 if v is None else v for v in least.values())


def test_empty_table(spark):
    docs = documents(spark, mixed_rows()).limit(0)
    assert S.near_duplicates(docs).count() == 0 and S.drop_near_duplicates(docs).count() == 0
