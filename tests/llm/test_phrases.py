"""Decontamination, line chunks and repeated passages against plain Python."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pricewright.llm import line_chunks, passages, phrase_index

from messy import CLASHES, SHARED, documents, prose, split, texts

ITEM = "item_id long, text string, term int, p int"


def sha(text: bytes | str) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute_contamination(docs, items, window=10):
    out = []
    for doc_id, text, *_ in docs:
        w = bench_words(text)
        hit, named = set(), set()
        for item_id, item in items:
            t = bench_words(item)
            n = min(window, len(t))
            wins = {tuple(t[i:i + n]) for i in range(len(t) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i:i + n]) in wins:
                    hit.update(range(i, i + n))
                    named.add("" if item_id is None else str(item_id))
        out.append((doc_id, len(w), len(hit), len(named), sha(",".join(sorted(named))), bool(hit)))
    return Counter(out)


ITEMS = [(1, SHARED), (2, "One two"), (3, "a b c a b"), (10, "nowhere to be found at all"), (4, None), (5, ""), (6, "!!"), (7, prose(2, 40)), (7, prose(3, 12)), (None, prose(8, 15)), (8, "x"), (9, SHARED)]


def test_contamination(spark):
    items = spark.createDataFrame([(i, t, 0, 0) for i, t in ITEMS], ITEM)
    got = phrase_index.contamination(documents(spark), items)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert Counter(map(tuple, got.collect())) == brute_contamination(texts(), ITEMS)


def test_contamination_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(phrase_index, "SMALL_ROWS", 0)
    items = spark.createDataFrame([(i, t, 0, 0) for i, t in ITEMS], ITEM)
    got = phrase_index.contamination(documents(spark), items)
    assert Counter(map(tuple, got.collect())) == brute_contamination(texts(), ITEMS)


def test_contamination_of_nothing(spark):
    none = spark.createDataFrame([], ITEM)
    got = phrase_index.contamination(documents(spark), none).collect()
    assert len(got) == len(texts()) and not any(r.contaminated for r in got)
    items = spark.createDataFrame([(i, t, 0, 0) for i, t in ITEMS], ITEM)
    assert phrase_index.contamination(documents(spark, []), items).count() == 0


def test_drop_contaminated(spark):
    items = spark.createDataFrame([(i, t, 0, 0) for i, t in ITEMS], ITEM)
    kept = phrase_index.drop_contaminated(documents(spark), items)
    clean = brute_contamination(texts(), ITEMS)
    assert kept.columns == documents(spark).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(k[0] for k, n in clean.items() for _ in range(n) if not k[5])


def test_proximity(spark):
    docs = documents(spark, [(1, "alpha x x beta x gamma", "en", "a"), (2, "gamma alpha beta", "en", "a"), (3, "alpha beta", "en", "a"), (4, "alpha " + "x " * 30 + "beta gamma", "en", "a")])
    tests = phrase_index.test_words(spark.createDataFrame([(1, "alpha beta gamma", 0, 0)], ITEM))
    found = phrase_index.proximity_matches(phrase_index.build_index(docs), tests, within=5)
    assert sorted(r.doc for r in found.select("doc").distinct().collect()) == [1, 2]


def test_index_without_terms_holds_every_word(spark):
    index = phrase_index.build_index(documents(spark))
    assert index.count() == sum(len(bench_words(t)) for _, t, *_ in texts())


def brute_passages(docs, window):
    first = {}
    for doc_id, text, *_ in docs:
        w = split(text)
        if doc_id is not None:
            for s in range(len(w) - window + 1):
                k = tuple(w[s:s + window])
                first[k] = min(first.get(k, doc_id), doc_id)
    out = []
    for doc_id, text, *_ in docs:
        w = split(text)
        stay = [True] * len(w)
        for s in range(len(w) - window + 1):
            if doc_id is not None and first[tuple(w[s:s + window])] < doc_id:
                stay[s:s + window] = [False] * window
        kept = [x for x, y in zip(w, stay) if y]
        out.append((doc_id, len(w), len(w) - len(kept), sha(b" ".join(kept))))
    return Counter(out)


@pytest.mark.parametrize("shard_bytes", [2 << 20, 1 << 10])
def test_passages(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(passages, "SHARD_BYTES", shard_bytes)
    got = passages.passage_digests(documents(spark))
    assert Counter(map(tuple, got.collect())) == brute_passages(texts(), 50)


def test_passages_with_a_short_window(spark):
    # Windows of 12 words, of which many overlap, begin alike and repeat inside one text.
    rows = [(i, " ".join(prose(i % 3, 60).split()[i:] + ["a", "b"] * 12 + prose(50 + i, 20).split()), "en", "a") for i in range(12)]
    got = passages.passage_digests(documents(spark, rows), window=12, phrase=4)
    assert Counter(map(tuple, got.collect())) == brute_passages(rows, 12)


def test_passages_of_nothing(spark):
    assert passages.passage_digests(documents(spark, [])).count() == 0
    got = passages.passage_digests(documents(spark, [(1, "a b", "en", "a"), (2, None, None, None)])).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == [(1, 2, 0), (2, 0, 0)]


def brute_chunks(docs, divisor=line_chunks.DIVISOR):
    """(kept text, lines, removed) per row."""
    cut = []
    for doc_id, text, *_ in docs:
        if text is None:
            cut.append([])
            continue
        chunks, here, before = [], [], 0
        for line in text.split("\n"):
            h = int(hashlib.md5(line.encode()).hexdigest()[:8], 16)
            here.append(line)
            if (h + 31 * before) % divisor == 0:
                chunks.append(here)
                here = []
            before = h
        cut.append([c for c in [*chunks, here] if c])
    seen = {}
    for (doc_id, text, *_), chunks in zip(docs, cut):
        for i, c in enumerate(chunks):
            seen.setdefault("\n".join(c), []).append((doc_id is None, doc_id or 0, text, i))
    out = []
    for (doc_id, text, *_), chunks in zip(docs, cut):
        kept, gone = [], 0
        for i, c in enumerate(chunks):
            # Two texts of one id are ordered by a hash that this check does not know; the table has none with a common chunk.
            if len(c) >= 2 and "".join(c).strip() and min(x for x in seen["\n".join(c)])[:2] + (i,) != (doc_id is None, doc_id or 0, i):
                gone += len(c)
            elif len(c) >= 2 and "".join(c).strip() and min(x for x in seen["\n".join(c)])[3] != i:
                gone += len(c)
            else:
                kept += c
        out.append((doc_id, None if text is None else "\n".join(kept), 0 if text is None else len(text.split("\n")), gone))
    return Counter(out)


def test_line_chunks(spark):
    got = line_chunks.remove_repeated_chunks(documents(spark), counts=True)
    assert got.columns == [*documents(spark).columns, "n_lines", "n_removed"]
    rows = Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect())
    want = brute_chunks(texts())
    assert rows == want
    assert sum(r[3] for r in rows) > 0
    assert all(r[CLASHES[0]] == 0 and r[CLASHES[1]] == 1 for r in got.collect())


def test_line_chunks_compare_bytes(spark, monkeypatch):
    # With one hash for all chunks, only the comparison of bytes tells them apart.
    real = F.xxhash64
    monkeypatch.setattr(line_chunks.F, "xxhash64", lambda *c: real(*c) % 1 if isinstance(c[0], str) else real(*c))
    rows = [(1, "aa\nbb\ncc\ndd", "en", "a"), (2, "aa\nbb\ncc\ndd", "en", "a"), (3, "ax\nbx\ncx\ndx", "en", "a")]
    got = line_chunks.remove_repeated_chunks(documents(spark, rows), divisor=1 << 40)
    assert {r.doc_id: r.text for r in got.collect()} == {1: rows[0][1], 2: "", 3: rows[2][1]}


def test_line_chunks_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(phrase_index, "SMALL_ROWS", 0)
    got = line_chunks.remove_repeated_chunks(documents(spark), counts=True)
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()) == brute_chunks(texts())


def test_line_chunks_of_nothing(spark):
    assert line_chunks.chunk_digests(documents(spark, [])).count() == 0


def brute_runs(docs):
    """(doc_id, kept text): every pair of lines, not all blank, that stands earlier goes."""
    first, out = {}, []
    for doc_id, text, *_ in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = None if text is None else text.split("\n")
        gone = set()
        for i, pair in enumerate(zip(lines or [], (lines or [])[1:])):
            place = first.setdefault(pair, (doc_id, text, i))
            if "".join(pair).strip() and place != (doc_id, text, i):
                gone |= {i, i + 1}
        out.append((doc_id, None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return Counter(out)


def test_repeated_runs_go_whole(spark):
    passage = prose(60, 200)
    rows = [(1, prose(61, 50) + "\n" + passage + "\n" + prose(62, 40), "en", "a"), (2, passage, "en", "a"), (3, "own head\n" + passage + "\nown tail", "en", "a"),
            (4, passage.split("\n")[3] + "\nown", "en", "a"), (5, "a\n\n\n\nb", "en", "a"), (6, "a\n\n\n\nb\nc", "en", "a")]
    got = {r.doc_id: r.text for r in line_chunks.remove_repeated_runs(documents(spark, rows)).collect()}
    assert got[1] == rows[0][1] and got[2] == "" and got[3] == "own head\nown tail" and got[4] == rows[3][1] and got[5] == rows[4][1] and got[6] in ("c", "\nc")
    chunks = {r.doc_id: r.text for r in line_chunks.remove_repeated_chunks(documents(spark, rows)).collect()}
    assert chunks[2] and len(chunks[3]) > len(got[3])


@pytest.mark.parametrize("small_rows", [500_000, 0])
def test_repeated_runs(spark, monkeypatch, small_rows):
    monkeypatch.setattr(phrase_index, "SMALL_ROWS", small_rows)
    got = line_chunks.remove_repeated_runs(documents(spark))
    assert got.columns == documents(spark).columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == brute_runs(texts())
    before, after = ({x for t in ts if t for x in t.split("\n")} for ts in ([r[1] for r in texts()], [r.text for r in got.collect()]))
    assert before == after | {""} or before == after
    assert line_chunks.remove_repeated_runs(documents(spark, [])).count() == 0
