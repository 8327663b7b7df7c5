"""The pipeline, each stage on what the one before kept."""

from collections import Counter, defaultdict
from itertools import combinations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pricewright.llm import base, line_chunks, mixing, phrase_index, simhash
from pricewright_queries.checker import compare, duck

from messy import documents, texts
from test_near import roots_of


def test_registered():
    names = entry.queries().keys()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "mixing"]


def brute_groups(texts):
    """Documents that SimHash within 2 bits or four fifths of common 5-word shingles link, by the smallest id."""
    prints = {i: simhash.fingerprint((t or "").encode()) for i, t in texts.items()}
    words = {i: (t or "").encode().lower().split() for i, t in texts.items()}
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    holders, common = defaultdict(list), Counter()
    for i, found in sets.items():
        for shingle in found:
            holders[shingle].append(i)
    for found in holders.values():
        common.update(combinations(found, 2))
    linked = [(a, b) for (a, b), n in common.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    linked += [(a, b) for a, b in combinations(texts, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    return roots_of(sorted(texts), linked)


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.01"  # where there are labels enough to learn from
    docs = base.read_table(spark, sf, "documents")
    columns = docs.columns
    seen = [{r.doc_id: r for r in docs.collect()}]
    for i, (name, function) in enumerate(corpus_pipeline.STAGES):
        out = function(spark, docs, sf)
        if i < 4:
            assert out.columns == columns and out.schema == docs.schema
            out.write.parquet(str(tmp_path / name))
            docs = spark.read.parquet(str(tmp_path / name))
            seen.append({r.doc_id: r for r in docs.collect()})
            assert seen[-1].keys() <= seen[-2].keys()
        else:
            mixed = {r.doc_id: r for r in out.collect()}
    labels = {r.doc_id: r for r in base.read_table(spark, sf, "labels").collect()}
    raw, good, cut, single, clean = seen
    assert good and len(good) < len(raw)
    told = [i for i in raw if i in labels]
    right = sum((i in good) == (labels[i].quality == 1 and labels[i].toxic == 0) for i in told)
    assert right >= 0.9 * len(told)
    assert cut.keys() == good.keys() and any(cut[i].text != good[i].text for i in cut)
    assert all(r.n_chars == len(r.text) for r in cut.values())
    assert single.keys() == set(brute_groups({i: r.text for i, r in cut.items()}).values()) != cut.keys()
    bad = {r.doc_id for r in phrase_index.contamination(spark.read.parquet(str(tmp_path / "near_duplicates")), base.read_table(spark, sf, "benchmark")).where("contaminated").collect()}
    assert bad and clean.keys() == single.keys() - bad
    assert mixed.keys() == clean.keys()
    assert sum(r.taken for r in mixed.values()) == pytest.approx(1.5 * sum(r["size"] for r in mixed.values()), rel=0.05)


def test_run(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"] and got.count() > 0


def test_stages_bear_messy_rows(spark, sf, tmp_path):
    for rows in (texts(), []):
        docs = documents(spark, rows)
        for i, (name, function) in enumerate(corpus_pipeline.STAGES[:-1]):
            function(spark, docs, sf).write.mode("overwrite").parquet(str(tmp_path / f"{len(rows)}{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{len(rows)}{name}"))
            assert docs.columns == documents(spark, rows).columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()
