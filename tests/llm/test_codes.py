"""Token alignment, vector codes and shards against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from math import floor, inf, nan

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pricewright.functions.hashing import hash52
from pricewright.llm import alignment, sharding, vector_codes
from pricewright.llm.base import read_table
from pyspark.sql import functions as F

from messy import documents, texts

ODD = [
    "two  spaces", " lead", "trail ", "\nline", "line\n\nbreak\nnext", "it's we'll 12 345", "<|endoftext|> <s> <0x0A> </s>", "U+2581 ▁ here", "▁", "é é ﬁ ½ 中文 🙂",
    "a b　c d\x1ce\x85f", "\r\nx\r\n", "\t\ttabs", " ", "\n", "don' t", "x" * 3000, "a​b", "\x00 nul \x00x",
]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(alignment.TOKENIZER_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.TOKENIZER_B)


def brute_groups(text, tokenizers):
    """The groups of a whole text, each a pair of lists of ids; none if its bytes do not come back."""
    if not text:
        return []
    a, b = tokenizers
    letters, whole = alignment.byte_alphabet(), f" {text}".encode()
    a_ids, b_ids = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)
    a_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return []

    def ends(parts):
        out, at = [], 0
        for part in parts:
            at += len(part)
            out.append(at)
        return out

    def cut(ids, parts, both):
        groups = [[]]
        for i, end in zip(ids, ends(parts)):
            groups[-1].append(i)
            if end in both:
                groups.append([])
        return groups[:-1]

    both = set(ends(a_bytes)) & set(ends(b_bytes))
    return list(zip(cut(a_ids, a_bytes, both), cut(b_ids, b_bytes, both)))


@pytest.mark.parametrize("head", [alignment.HEAD_PAIRS, 0, 300])
def test_alignment(spark, tokenizers, monkeypatch, head):
    monkeypatch.setattr(alignment, "HEAD_PAIRS", head)
    rows = texts() + [(100 + i, t, "en", "a") for i, t in enumerate(ODD)] + [(200, ODD[4], "en", "a"), (201, ODD[4], "en", "b")]
    got = alignment.align_documents(documents(spark, rows))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = [brute_groups(t, tokenizers) for _, t, *_ in rows]
    pairs = [Counter((a, b) for x, y in groups for a in x for b in y) for groups in found]
    count = Counter(p for c in pairs for p in c)
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    want = []
    for (i, *_), groups, linked in zip(rows, found, pairs):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        want.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(linked.values()),
                     sum(n for p, n in linked.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in linked.items()),
                     hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_pair_table(spark, tokenizers):
    table = {(r.a, r.b): (r.documents, r.best) for r in alignment.pair_table(alignment.aligned_texts(documents(spark, [(1, "cat", "", ""), (2, "cat", "", ""), (3, "cats", "", "")]))).collect()}
    (a,), (b,) = brute_groups("cat", tokenizers)[0]
    assert table[a, b] == (2, True)


def test_alignment_of_whole_texts(spark, sf, tokenizers):
    """Cutting texts into chunks changes no token, whatever is remembered or forgotten."""
    models = [open(p, "rb").read() for p in (alignment.TOKENIZER_A, alignment.TOKENIZER_B)]
    aligner = alignment.Aligner(*models)
    draw = random.Random(3)
    bits = ["a", "Bc", "'s", " ", " ", "\n", "\t", "　", "\xa0", "\x1c", "é", "é", "12", "<s>", "🙂", "\r\n", "  ", ".", ",", "²."]
    mixed = ["".join(draw.choice(bits) for _ in range(draw.randint(1, 30))) for _ in range(400)]
    for text in [t for (t,) in read_table(spark, sf, "documents").select("text").collect() if t][:100] + mixed + ODD:
        groups = brute_groups(text, tokenizers)
        whole = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        numbers, digest, *_ = next(aligner.align([text]))
        assert numbers[:3] == (sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups)), text
        assert digest == (hashlib.sha256(whole.encode()).hexdigest() if groups else "")


def test_forgetting(monkeypatch):
    models = [open(p, "rb").read() for p in (alignment.TOKENIZER_A, alignment.TOKENIZER_B)]
    wanted = [t for _, t, *_ in texts() if t]
    whole = [(r[0], r[1]) for r in alignment.Aligner(*models).align(wanted)]
    monkeypatch.setattr(alignment, "REMEMBERED", 10)
    short = alignment.Aligner(*models)
    assert short.cuts
    assert [next(short.align([t]))[:2] for t in wanted] == whole


def test_alignment_of_nothing(spark):
    assert alignment.align_documents(documents(spark, [])).count() == 0
    assert [tuple(r)[1:] for r in alignment.align_documents(documents(spark, [(1, None, "", ""), (None, "", "", "")])).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


# Vector codes


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2) for i, v, label in rows], "vec_id long, embedding array<float>, label int, _vector int, code int")


def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v)]
    width = len(kept[0][1]) // parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[cut[k][p] for k in order] for p in range(parts)]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for row in cut:
                members[nearest(row[p], books[p])[1]].append(row[p])
            books[p] = [tuple(sum(c) // len(members[e]) for c in zip(*members[e])) if e in members else entry for e, entry in enumerate(books[p])]
    final = [[nearest(row[p], books[p]) for p in range(parts)] for row in cut]
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    errors = [sum(d for d, _ in row) for row in final]
    by_label = Counter()
    for (_, _, label), error in zip(kept, errors):
        by_label[label] += error
    return Counter((i, "".join(f"{e:02x}" for _, e in row), error, by_label[label], digest) for (i, _, label), row, error in zip(kept, final, errors))


def test_codes(spark):
    draw = random.Random(5)
    rows = [(i, [draw.choice([-0.5, -0.25, 0.0, 0.25, draw.gauss(0, 1)]) for _ in range(32)], draw.choice([None, 1, 2])) for i in range(300)]
    rows += [(7, rows[8][1], 1), (7, rows[8][1], 1), (None, rows[9][1], None), (-5, [0.0] * 32, 2), (301, None, 1), (302, [nan] + [0.0] * 31, 1),
             (303, [inf] + [0.0] * 31, 1), (304, [None] + [0.0] * 31, 1), (305, [-0.001] * 32, 3)]
    got = vector_codes.compress_vectors(vectors(spark, rows))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(map(tuple, got.collect())) == brute_codes(rows)


def test_few_vectors(spark):
    rows = [(i, [float(i)] * 16, None) for i in range(3)]
    assert Counter(map(tuple, vector_codes.compress_vectors(vectors(spark, rows)).collect())) == brute_codes(rows)
    assert vector_codes.compress_vectors(vectors(spark, [])).collect() == []
    assert vector_codes.compress_vectors(vectors(spark, [(1, None, 1), (2, [], 1), (2, [nan], 1)])).count() == 0
    other = vector_codes.compress_vectors(vectors(spark, [*rows, (9, [1.0] * 32, 1), (10, [1e38] * 16, 1)]))
    assert {r.vec_id: r.error for r in other.collect()}.keys() == {0, 1, 2, 10}
    with pytest.raises(ValueError):
        vector_codes.compress_vectors(vectors(spark, [(1, [1.0] * 17, 1)]))


def test_search_compares_few():
    """The search leaves out most entries, and never one that is nearer or as near with a lower index."""
    draw = np.random.default_rng(2)
    book, parts = draw.integers(-300, 300, (256, 4)), draw.integers(-300, 300, (4000, 4))
    book[100:110] = book[50:60]
    parts[:60] = book[60:120]
    at, distance, compared = vector_codes.nearest_entries(parts, book)
    whole = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    assert (at == whole.argmin(axis=1)).all() and (distance == whole.min(axis=1)).all()
    assert compared < 0.5 * whole.size


def test_decode(spark):
    rows = [(i, [float(i % 5)] * 16, 1) for i in range(20)]
    usable, dims = vector_codes.usable(vectors(spark, rows), "vec_id", "embedding", [])
    books = vector_codes.fit_codebooks(usable, dims)
    for row in vector_codes.encode(usable, books, dims, ["_id"]).collect():
        assert row.error == 0 and vector_codes.decode(row.code, books) == [256 * (row[0] % 5)] * 16


# Shards


def brute_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b, j


def brute_key(i):
    return 0 if i is None else int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:13], 16)


@pytest.mark.parametrize("shards", [1, 2, 40, 1000])
def test_jump(spark, shards):
    keys = [0, 1, 2**63 - 1, 2**52 - 1, *(random.Random(n).randrange(2**63) for n in range(500))]
    got = spark.createDataFrame([(k,) for k in keys], "key long").select("key", sharding.jump(F.col("key"), shards).alias("s")).collect()
    assert [(r.key, (r.s.shard, r.s.next)) for r in got] == [(k, brute_jump(k, shards)) for k in keys]


def test_jumps_beyond_the_usual(spark, monkeypatch):
    monkeypatch.setattr(sharding.math, "log", lambda _: -3)
    keys = [random.Random(n).randrange(2**63) for n in range(500)]
    got = spark.createDataFrame([(k,) for k in keys], "key long").select("key", sharding.jump(F.col("key"), 5000).alias("s")).collect()
    assert [(r.key, (r.s.shard, r.s.next)) for r in got] == [(k, brute_jump(k, 5000)) for k in keys]


@pytest.mark.parametrize("bucket, at_once", [(sharding.ROWS_PER_BUCKET, sharding.COPIES_AT_ONCE), (2, 1)])
def test_shards(spark, monkeypatch, bucket, at_once):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", bucket)
    monkeypatch.setattr(sharding, "COPIES_AT_ONCE", at_once)
    rows = texts() + [(i, f"text {i}", "en", "a") for i in range(100, 400)] + [(13, "again", "en", "a")] * 9
    got = sharding.shard_documents(documents(spark, rows)).collect()
    want = []
    for i, t, *_ in rows:
        data = (t or "").encode()
        shard, following = brute_jump(brute_key(i), 40)
        assert following == 40 or brute_jump(brute_key(i), 41)[0] == shard
        want.append((i, len(data) + 16, zlib.crc32(data), "key", shard, 40 if following == 40 else shard, following))
    assert Counter(tuple(r)[:5] + tuple(r)[6:] for r in got) == Counter(want)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = sharding.shard_documents(documents(spark, rows).repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert any(r.grown_shard == 40 for r in got)


def test_moving_rows(spark):
    docs = documents(spark, [(i, "x", "en", "a") for i in range(2000)])
    moved = {r.doc_id: (r.shard, r.new_shard) for r in sharding.moving_rows(docs, 40, 44).collect()}
    want = {i: (brute_jump(brute_key(i), 40)[0], brute_jump(brute_key(i), 44)[0]) for i in range(2000)}
    assert moved == {i: x for i, x in want.items() if x[0] != x[1]}
    assert all(new >= 40 for _, new in moved.values()) and 0.05 < len(moved) / 2000 < 0.14


def test_written_shards(spark, tmp_path):
    docs = documents(spark)
    clean = docs.drop("shard")
    sharding.write_shards(clean, str(tmp_path / "out"), 5, rows_per_file=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((i, t) for i, t, *_ in texts())
    assert all(r.shard == brute_jump(brute_key(r.doc_id), 5)[0] for r in back.collect())


def test_shards_of_nothing(spark):
    assert sharding.shard_documents(documents(spark, [])).count() == 0


def test_keys_by_hash(spark):
    got = [r.k for r in spark.createDataFrame([(5,), (None,)], "i long").select(hash52(42, F.col("i")).alias("k")).collect()]
    assert got == [brute_key(5), None]
