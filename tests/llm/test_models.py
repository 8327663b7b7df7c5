"""Lattice scores and the site classifier."""

import math
import zlib
from collections import Counter, defaultdict
from itertools import product
from math import exp, log

import pytest
from pyspark.sql import functions as F

from pricewright.llm import lattice, site_quality

from messy import documents, prose, split, texts


def brute_marginal(text, scores, byte_scores):
    """Sum over every way to cut the text."""
    if not text:
        return 1.0
    total = 0.0
    for i in range(1, len(text) + 1):
        head = text[:i]
        if head in scores:
            p = math.exp(scores[head])
        elif i == 1:
            p = math.exp(sum(byte_scores[b] for b in head.encode()))
        else:
            continue
        total += p * brute_marginal(text[i:], scores, byte_scores)
    return total


def test_marginal_sums_all_segmentations():
    scores = {"▁": -1.0, "▁a": -1.5, "a": -2.0, "b": -2.5, "ab": -0.7, "▁ab": -3.0, "bab": -1.1, "abab": -4.0}
    pieces = lattice.Pieces(scores, [-5.0 - b / 100 for b in range(256)])
    for word in ["", "a", "b", "ab", "abab", "babab", "é", "aéb", "ababababab"]:
        assert math.exp(pieces.log_marginal(word)) == pytest.approx(brute_marginal("▁" + word, scores, pieces.byte_scores))


def test_marginal_of_a_very_long_word():
    pieces = lattice.Pieces({"▁": -1.0, "x": -2.0}, [-5.0] * 256)
    assert pieces.log_marginal("x" * 200_000) == pytest.approx(-400_001.0)


def check_scores(spark, rows, **options):
    got = lattice.score_texts(documents(spark, rows), **options)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    counts, held = Counter(), []
    for i, t, *_ in rows:
        held.append(i is not None and zlib.crc32(str(i).encode()) % 10 == 0)
        if not held[-1]:
            counts.update([*(t or "").encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for (i, t, *_), h in zip(rows, held):
        tokens = [*(t or "").encode().lower().split(), None]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        want[(i, h, len(tokens), sum(1 for w in tokens if counts[w]), n, round(base, 5))] += 1
    out = got.collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out) == want
    assert all(r.score < 0 for r in out)
    return out


def test_scores(spark):
    head = check_scores(spark, texts())
    assert any(r.held_out for r in head)


def test_scores_do_not_depend_on_the_head(spark, monkeypatch):
    whole = {(r.doc_id, round(r.base_score, 5)): r.score for r in check_scores(spark, texts())}
    monkeypatch.setattr(lattice, "HEAD_WORDS", 2)
    monkeypatch.setattr(lattice, "COUNTED", 50)
    for r in check_scores(spark, texts()):
        assert r.score == pytest.approx(whole[(r.doc_id, round(r.base_score, 5))], rel=1e-9)


def test_scores_of_little(spark):
    assert lattice.score_texts(documents(spark, [])).count() == 0
    check_scores(spark, [(1, None, "en", "a"), (2, "", "en", "a")])


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus():
    """Clean, junk and toxic texts on hosts of different kinds."""
    rows, labels = [], []
    for i in range(600):
        text, low, toxic = prose(1000 + i, 60), 0, 0
        host = "mixed" if i % 3 else f"small{i % 50}"
        if i % 10 == 0:
            text, low = " ".join(w + "%%%" for w in text.split()), 1
        if i % 10 == 1:
            text, toxic = text + " slur" + " vile", 1
        rows.append((i, text, "en", host))
        if i < 400:
            labels.append((i, 1 - low, toxic))
    return rows, labels


def test_quality_on_unlabelled_documents(spark):
    rows, labels = corpus()
    got = {r.doc_id: r for r in site_quality.site_quality(documents(spark, rows), labelled(spark, labels)).collect()}
    for i in range(400, 600):
        assert got[i].rejected == (i % 10 in (0, 1)), i
        assert (got[i].p_low > 0.5) == (i % 10 == 0) and (got[i].p_toxic > 0.5) == (i % 10 == 1)
    kept = site_quality.keep_good(documents(spark, rows), labelled(spark, labels))
    assert kept.columns == documents(spark, rows).columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if not got[i].rejected}


def test_rates_shrink_sparse_sites(spark):
    rows = [("big", "p", 0.0, 8.0)] * 50 + [("big", "p", 0.0, -8.0)] * 50 + [("tiny", "q", 0.0, 8.0)] + [(f"h{i}", "p", 0.0, -8.0) for i in range(100) for _ in range(5)]
    rows += [("big", "rare", 0.0, -8.0), (None, None, 0.0, -8.0)]
    scored = spark.createDataFrame(rows, "_host string, _path string, low_evidence double, toxic_evidence double")
    rates = {(r._host, r._path): r for r in site_quality.site_rates(scored, [0.0, 0.0]).collect()}
    everywhere = 51 / len(rows)
    assert everywhere < rates["tiny", "q"].toxic_rate < 1
    assert 0.45 < rates["big", "p"].toxic_rate < 0.52
    # A path of one clean document stays near its host, not at 0.
    assert 0.02 < rates["big", "rare"].toxic_rate < rates["big", "p"].toxic_rate
    assert rates["h1", "p"].toxic_rate < everywhere
    assert (None, None) in rates and all(0 < r.low_rate < 1 for r in rates.values())


def brute_rates(rows, prior):
    """(host, path) to the posterior rate of one kind, from (host, path, evidence)."""
    sigmoid = lambda x: 1 / (1 + exp(-x))
    paths = defaultdict(lambda: [0, 0.0])
    for host, path, evidence in rows:
        paths[host, path][0] += 1
        paths[host, path][1] += sigmoid(evidence + prior)
    hosts = defaultdict(lambda: [0, 0.0])
    for (host, _), (n, bad) in paths.items():
        hosts[host][0] += n
        hosts[host][1] += bad
    mean = sum(bad for _, bad in hosts.values()) / len(rows)
    mean = min(max(mean, 0.5 / (len(rows) + 1)), (len(rows) + 0.5) / (len(rows) + 1))

    def worth(groups):
        """(n, rate, around)"""
        total = sum(n for n, *_ in groups)
        between = (sum(n * (rate - around) ** 2 for n, rate, around in groups) - sum(a * (1 - a) for *_, a in groups)) / total
        within = sum(n * a * (1 - a) for n, _, a in groups) / total
        return min(max(within / between - 1, 1.0), 1e6) if between > 0 else 1e6

    k = worth([(n, bad / n, mean) for n, bad in hosts.values()])
    of_host = {h: (bad + k * mean) / (n + k) for h, (n, bad) in hosts.items()}
    k = worth([(n, bad / n, of_host[h]) for (h, _), (n, bad) in paths.items()])
    return {(h, p): (bad + k * of_host[h]) / (n + k) for (h, p), (n, bad) in paths.items()}


def test_posterior_by_brute_force(spark, monkeypatch):
    """Rates of paths, and the probability of each document from them and its own evidence."""
    rows, labels = corpus()
    rows = [(i, t, "en" if i % 4 else "fr", h if i % 9 else None) for i, t, _, h in rows]
    fitted = site_quality.fit(documents(spark, rows), labelled(spark, labels))
    evidence = {}
    for i, text, lang, host in rows:
        found = site_quality.features(text.encode())
        evidence[i] = []
        for k, kind in enumerate(("low", "toxic")):
            score = sum(fitted["weights"].get(f, (0.0, 0.0))[k] for f in found)
            cell = sum(len(found) > b for b in site_quality.SIZES), sum(score > b for b in site_quality.SCORES)
            evidence[i].append(fitted["cells"][kind].get(cell, score))
    assert any(e[0] < 0 for e in evidence.values()) and any(e[0] > 0 for e in evidence.values())
    rates = [brute_rates([(h, g, evidence[i][k]) for i, _, g, h in rows], fitted["prior"][k]) for k in (0, 1)]
    got = {r.doc_id: (r.p_low, r.p_toxic) for r in site_quality.site_quality(documents(spark, rows), labelled(spark, labels)).collect()}
    for i, _, lang, host in rows:
        for k in (0, 1):
            rate = rates[k][host, lang]
            assert got[i][k] == pytest.approx(1 / (1 + exp(-evidence[i][k] - log(rate / (1 - rate)))), rel=1e-6)


def test_clean_documents_of_a_bad_source_stay(spark):
    """A source that is four fifths junk: the site accuses, but a text without marks of junk speaks for itself, long ones too."""
    rows, labels = corpus()
    for i in range(1000, 1500):
        junk = i % 5 != 0
        text = prose(i, 900 if i % 50 == 0 else 60)
        rows.append((i, " ".join(w + "%%%" for w in text.split()) if junk else text, "en", "bad"))
        if i % 2:
            labels.append((i, int(not junk), 0))
    got = {r.doc_id: r for r in site_quality.site_quality(documents(spark, rows), labelled(spark, labels)).collect()}
    wrong = [i for i in range(1000, 1500) if got[i].rejected != (i % 5 != 0)]
    assert wrong == [], [(i, got[i]) for i in wrong][:3]


def test_quality_of_messy_rows(spark):
    labels = labelled(spark, [(1, 1, 0), (2, 0, 0), (None, 0, 1), (3, None, 1), (1, 1, 0), (999, 0, 1)])
    got = site_quality.site_quality(documents(spark), labels).collect()
    assert len(got) == len(texts()) and all(r.p_low is not None and r.p_toxic is not None for r in got)


def test_quality_without_labels_or_documents(spark):
    none = labelled(spark, [])
    assert not any(r.rejected for r in site_quality.site_quality(documents(spark), none).collect())
    assert site_quality.site_quality(documents(spark, []), labelled(spark, [(1, 1, 0)])).count() == 0
    assert site_quality.keep_good(documents(spark), none).count() == len(texts())
