"""SimHash groups, components and neighbour search against plain Python."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from pricewright.llm import collisions, components, simhash

from messy import documents, split, texts


def brute_print(text, n=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for i in range(64):
            ones[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(shingles))


def roots_of(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_roots(prints):
    distinct = sorted(set(prints))
    near = [(a, b) for i, a in enumerate(distinct) for b in distinct[i:] if (a ^ b).bit_count() <= 2]
    return roots_of(distinct, near)


def test_print_of_many_shingles(monkeypatch):
    text = texts()[7][1]
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "AT_ONCE", 1000)
    assert simhash.fingerprint(text.encode()) == whole == brute_print(text)


def test_groups(spark):
    rows = texts()
    got = simhash.simhash_groups(documents(spark))
    prints = [brute_print(t) for _, t, *_ in rows]
    roots = brute_roots(prints)
    low = {}
    for (i, *_), p in zip(rows, prints):
        if i is not None:
            low[roots[p]] = min(low.get(roots[p], i), i)
    want = Counter((i, f"{p:016x}", low.get(roots[p])) for (i, *_), p in zip(rows, prints))
    assert Counter(map(tuple, got.collect())) == want


def test_groups_of_nothing(spark):
    assert simhash.simhash_groups(documents(spark, [])).count() == 0


def test_keep_one(spark):
    rows = texts()
    got = simhash.keep_one_of_each(documents(spark))
    assert got.columns == documents(spark).columns
    roots = brute_roots([brute_print(t) for _, t, *_ in rows])
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(roots[brute_print(t)], []).append(i)
    want = sorted((min((i for i in ids if i is not None), default=None) for ids in groups.values()), key=str)
    assert sorted((r.doc_id for r in got.collect()), key=str) == want


@pytest.mark.parametrize("crowded", [64, 3, 0])
def test_links_of_any_crowding(spark, crowded):
    """Clusters that share a segment, chains, and the extreme bits; the bound on a bucket changes nothing."""
    draw = random.Random(3)
    prints = {0, (1 << 64) - 1, 1 << 63, 1 << 31, 1 << 32}
    for _ in range(6):
        centre = draw.getrandbits(64)
        for _ in range(40):
            value = centre
            for _ in range(draw.randint(0, 4)):
                value ^= 1 << draw.randrange(64)
            prints.add(value)
        prints.update((centre >> 32 << 32) | draw.getrandbits(32) for _ in range(20))
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    pairs = [(r.a, r.b) for r in simhash.near_pairs(df, crowded=crowded).collect()]
    back = {s: p for p, s in signed.items()}
    assert all((back[a] ^ back[b]).bit_count() <= 2 for a, b in pairs)
    got = roots_of(sorted(prints), [(back[a], back[b]) for a, b in pairs])
    assert got == brute_roots(prints)


def test_components(spark):
    draw = random.Random(1)
    chain = list(range(-50, 150))
    draw.shuffle(chain)
    edges = list(zip(chain, chain[1:])) + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (6001, 6000), (None, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    whole = [e for e in edges if None not in e]
    assert got == roots_of(sorted({x for e in whole for x in e}), whole)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, embedding array<float>, v int, dim int")


def brute_nearest(rows, k=20, every=20):
    table = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    out = {}
    for q, v in table:
        if q % every == 0:
            hits = sorted(((-float((w * v).sum()), i) for i, w in table if i != q))[:k]
            out[q] = [(i, -s) for s, i in hits]
    return out


def test_nearest_recall(spark):
    draw = np.random.default_rng(5)
    rows = [(i, (draw.normal(size=24) * draw.uniform(0.2, 3)).tolist()) for i in range(1500)]
    got = {}
    for r in collisions.nearest(vectors(spark, rows)).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    want = brute_nearest(rows)
    assert got.keys() == want.keys()
    found = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q].values()}) for q in want) / (20 * len(want))
    assert found >= 0.9
    for q, hits in got.items():
        assert sorted(hits) == list(range(1, 21))
        exact = dict(brute_nearest([r for r in rows], k=1500)[q]) if q == 0 else {}
        assert all(abs(exact.get(i, s) - s) < 1e-9 for i, s in hits.values())


def kinds_of_vectors():
    draw = np.random.default_rng(7)
    centres = draw.normal(size=(40, 32)) * 3
    one_long = draw.normal(size=(3000, 32))
    one_long[17] *= 100
    return {
        "random": draw.normal(size=(3000, 32)),
        "clustered": centres[draw.integers(0, 40, 3000)] + draw.normal(size=(3000, 32)) * 0.15,
        "one long vector": one_long,
        "lengths of all sizes": draw.normal(size=(3000, 32)) * np.exp(draw.normal(size=(3000, 1)) * 2),
    }


@pytest.mark.parametrize("kind", kinds_of_vectors())
def test_recall_and_share_verified_by_kind(kind):
    vectors = kinds_of_vectors()[kind]
    ids = np.arange(len(vectors))
    index = collisions.BlockIndex(ids, vectors, seed=11)
    hits = verified = 0
    for q in range(0, 3000, 50):
        found, scores, n = index.search(q, vectors[q], 20)
        products = vectors @ vectors[q]
        products[q] = -np.inf
        hits += len(set(np.argsort(-products)[:20]) & set(found.tolist()))
        verified += n
        assert np.allclose(scores, products[found])
    recall, share = hits / (60 * 20), verified / (60 * 3000)
    print(kind, "recall", round(recall, 3), "verified", round(share, 3))
    assert recall >= 0.95
    if kind in ("clustered", "lengths of all sizes"):
        assert share < 0.5


def test_blocks_in_any_order(spark, monkeypatch):
    """Many small blocks and small batches find the same as one block's exact search of few vectors."""
    draw = np.random.default_rng(6)
    rows = [(i, (draw.normal(size=8)).tolist()) for i in range(400)] + [(1000 + i, draw.normal(size=5).tolist()) for i in range(40)]
    monkeypatch.setattr(collisions, "BLOCK", 50)
    got = {}
    for r in collisions.nearest(vectors(spark, rows), k=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    want = {q: hits for part in (rows[:400], rows[400:]) for q, hits in brute_nearest(part, k=3).items()}
    found = sum(len({i for i, _ in want[q]} & {i for _, i in got[q]}) for q in want)
    assert got.keys() == want.keys() and found >= 0.9 * 3 * len(want)


def test_nearest_ties_few_and_bad(spark):
    same = [1.0, 2.0]
    rows = [(20, same), (5, same), (3, same), (4, [float("nan"), 1.0]), (6, [0.0, 0.0]), (7, None), (8, [1.0, None]), (9, [float("inf"), 0.0]), (40, [2.0, 2.0, 2.0]), (None, same), (60, [-1.0, 0.5]), (80, [0.0, 0.0])]
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in collisions.nearest(vectors(spark, rows)).collect()]
    assert sorted(got) == [(20, 1, 3, 5.0), (20, 2, 5, 5.0), (20, 3, 60, 0.0), (60, 1, 3, 0.0), (60, 2, 5, 0.0), (60, 3, 20, 0.0)]
    assert collisions.nearest(vectors(spark, [])).count() == 0


def test_repeated_queries(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 1.0])]
    got = [(r.query_id, r.vec_id) for r in collisions.nearest(vectors(spark, rows)).collect()]
    assert got == [(20, 1)]


def brute_alike(text, other):
    a, b = ({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if (w := t.encode().lower().split()) else set() for t in (text, other))
    return bool(a and b) and len(a & b) >= 0.8 * len(a | b)


def variants():
    """Copies with one to eight words changed, chains of them, and texts of their own."""
    draw, rows = random.Random(11), []
    for base in range(12):
        own = [f"w{draw.randrange(5000)}" for _ in range(draw.randint(60, 300))]
        for k in range(6):
            if k % 3 == 2:
                own = list(own)
                own[draw.randrange(len(own))] = f"chain{base}x{k}"
            copy = list(own)
            for _ in range(k * 2 % 9):
                copy[draw.randrange(len(copy))] = f"new{base}x{draw.randrange(10 ** 6)}"
            rows.append((100 * base + k, " ".join(copy), "en", "a"))
    return rows


def test_keep_one_of_texts_alike(spark):
    rows = variants()
    by = dict(r[:2] for r in rows)
    prints = {i: brute_print(t) for i, t in by.items()}
    linked = [(a, b) for a in by for b in by if a < b and ((prints[a] ^ prints[b]).bit_count() <= 2 or brute_alike(by[a], by[b]))]
    far = [(a, b) for a, b in linked if (prints[a] ^ prints[b]).bit_count() > 2]
    assert len(far) > 20
    want = set(roots_of(sorted(by), linked).values())
    got = {r.doc_id for r in simhash.keep_one_of_each(documents(spark, rows), alike=True).collect()}
    assert got == want and len({r.doc_id for r in simhash.keep_one_of_each(documents(spark, rows)).collect()}) > len(want)


def test_alike_bears_messy_rows(spark):
    got = simhash.keep_one_of_each(documents(spark), alike=True)
    assert got.columns == documents(spark).columns and 0 < got.count() <= simhash.keep_one_of_each(documents(spark)).count()
    assert simhash.keep_one_of_each(documents(spark, []), alike=True).count() == 0
