"""The mix of sources: its targets, its blocks, and what it takes."""

from collections import Counter, defaultdict

import pytest

from pricewright.llm import mixing

from messy import documents, split, texts


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            target.update({s: level * weight[s] for s in open_})
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("block", [128, 7])
def test_mix(spark, block):
    rows = texts()
    got = mixing.mix_documents(documents(spark), block=block).collect()
    size = [len(split(t)) for _, t, *_ in rows]
    by_source = defaultdict(int)
    for (_, _, _, s), n in zip(rows, size):
        by_source[s] += n
    target = brute_targets(by_source)
    assert sum(target.values()) == pytest.approx(1.5 * sum(size))
    assert Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6)) for r in got) == Counter(
        (i, n, by_source[s], round(target[s], 6)) for (i, _, _, s), n in zip(rows, size))
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    taken = defaultdict(int)
    for r in got:
        taken[(r.source_size, r.target)] += r.taken
    for (n, want), t in taken.items():
        assert abs(t - want) <= 1.5 * min(block, n)
    again = mixing.mix_documents(documents(spark).repartition(3), block=block).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_blocks_are_what_is_taken(spark):
    parts = mixing.mixed_blocks(documents(spark), block=16, shard_slots=64).collect()
    taken = Counter()
    for p in parts:
        taken[p.doc_id] += p.n_words
    want = Counter()
    for r in mixing.mix_documents(documents(spark), block=16).collect():
        want[r.doc_id] += r.taken
    assert taken == +want
    slots = {p.slot for p in parts}
    assert slots == set(range(max(slots) + 1)) and all(p.shard == p.slot // 64 for p in parts)
    # A slot shows one block of one source, and no word of it twice.
    for slot in slots:
        mine = [p for p in parts if p.slot == slot]
        assert len({(p.source, p.block) for p in mine}) == 1 and sum(p.n_words for p in mine) <= 16


def test_counts_per_shard_vary_around_their_share(spark):
    rows = [(i, "w " * 500, "en", "abc"[i % 3]) for i in range(60)]
    counts = mixing.shard_counts(documents(spark, rows), block=10, shard_slots=100).collect()
    whole = Counter()
    for r in counts:
        whole[r.source] += r.slots
    share = {s: n / sum(whole.values()) for s, n in whole.items()}
    full = [r for r in counts if r.shard < sum(whole.values()) // 100]
    off = [(r.slots - 100 * share[r.source]) / (100 * share[r.source] * (1 - share[r.source])) ** 0.5 for r in full]
    assert 0.5 < sum(x * x for x in off) / len(off) < 1.5


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 100, 1000, 4097])
def test_permutation(spark, n):
    df = spark.range(n).selectExpr("id", f"cast({n} as bigint) as n")
    out = [r.p for r in mixing.permuted(df, "id", "n", [1], "p").orderBy("id").collect()]
    assert sorted(out) == list(range(n))
    assert n < 64 or sum(a == i for i, a in enumerate(out)) < n / 8


def test_mix_of_little(spark):
    assert mixing.mix_documents(documents(spark, [])).count() == 0
    got = mixing.mix_documents(documents(spark, [(1, None, "en", None), (2, "", "en", "a")])).collect()
    assert sorted((r.doc_id, r["size"], r.target, r.taken) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    (one,) = mixing.mix_documents(documents(spark, [(1, "a b c", "en", "a")])).collect()
    assert (one.target, one.taken) == (4.5, 6)
