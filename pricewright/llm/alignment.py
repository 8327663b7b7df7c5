"""Align the tokens of two tokenizers over a corpus.

Texts are shuffled by their full content, so each distinct text is tokenised
and aligned once, weighted by how many documents hold it; the measures are then
joined to the documents.
"""

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .base import ship_package, stage

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
#: Chunks of the younger half of what a task remembers, bytes of text aligned together, and the most id pairs that are broadcast (17 bytes each).
REMEMBERED, BYTES_AT_ONCE, HEAD_PAIRS, ROWS_AT_ONCE = 80_000, 1 << 20, 1_000_000, 1024
#: Places that no token of either kind reaches over: before a space or line end that stands alone between characters which are no white space, and before a stop.
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=[a-z])(?=[.,])")
#: A piece of B that would reach over one.
CROSSING = re.compile(r"[^▁][▁\n]|\n.|[a-z][.,]")

MEASURES = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = "text_id binary, n long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, links array<int>"
SCORED = "text_id binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, rest array<struct<pair:long,links:int>>"


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others numbered from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Two tokenizers, and the alignments of the chunks met lately.

    A text and the space before it are cut at the places of ``CUT``. Both tokenizers cut there anyway: A's
    pattern ends a word there, and no piece of B reaches over them. So the chunks' tokens are the text's. With tokenizers of
    which that does not hold, a text is one chunk.
    """

    def __init__(self, a_model: bytes, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_buffer(a_model)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = byte_alphabet()
        self.a_bytes = {i: bytes(letters[c] for c in entry) if letters.keys() >= set(entry) else entry.encode()
                        for entry, i in self.a.get_vocab().items()}
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        rules = json.loads(self.a.to_str())
        words = rules["normalizer"] is None and (rules["pre_tokenizer"] or {}).get("type") == "ByteLevel" and rules["pre_tokenizer"].get("use_regex")
        whole = range(self.b.get_piece_size())
        self.cuts = bool(words) and not any(CROSSING.search(self.b.id_to_piece(i)) for i in whole if not self.b.is_byte(i))
        self.young, self.old = {}, {}

    def _aligned(self, chunk: str, a: list[int], b: list[int]) -> tuple[tuple[int, ...], str, bytes] | None:
        """The numbers of ``MEASURES``, the groups and the id pairs of one chunk; none if its bytes do not come back."""
        whole = chunk.encode("utf-8", "surrogatepass")
        a_parts, b_parts = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        if b"".join(a_parts) != whole or b"".join(b_parts) != whole:
            return None
        groups, pairs, b_ends = [], [], {end: j for j, end in enumerate(accumulate(map(len, b_parts)), 1)}
        a_first = b_first = 0
        for i, end in enumerate(accumulate(map(len, a_parts)), 1):
            j = b_ends.get(end)
            if j is None:
                continue
            if i == a_first + 1 and j == b_first + 1:
                x, y = a[a_first], b[b_first]
                groups.append(f"{x}|{y}")
                pairs.append(x << 32 | y)
            else:
                mine, theirs = a[a_first:i], b[b_first:j]
                groups.append(",".join(map(str, mine)) + "|" + ",".join(map(str, theirs)))
                pairs += [x << 32 | y for x in mine for y in theirs]
            a_first, b_first = i, j
        return (len(a), len(b), len(groups), len(pairs)), ";".join(groups), array("q", pairs).tobytes()

    def _learn(self, chunks: set[str]) -> None:
        """Have all ``chunks`` among the young; what was not met since the young last became the old is forgotten."""
        if len(self.young) > REMEMBERED:
            self.young, self.old = {}, self.young
        new = []
        for chunk in chunks - self.young.keys():
            if chunk in self.old:
                self.young[chunk] = self.old[chunk]
            else:
                new.append(chunk)
        if new:
            a = self.a.encode_batch_fast(new, add_special_tokens=False)
            # B puts a space before what it is given: a chunk's own, or with a line end two tokens to be left out again.
            b = self.b.encode([c[1:] if c[0] == " " else f"\n{c}" for c in new], num_threads=1)
            for chunk, x, y in zip(new, a, b):
                self.young[chunk] = self._aligned(chunk, x.ids, y if chunk[0] == " " else y[2:])

    def align(self, texts: list[str]) -> Iterator[tuple]:
        """Per text: the numbers of ``MEASURES``, the digest of its groups, its distinct id pairs and their numbers of links."""
        cut = [CUT.split(f" {text}") if self.cuts else [f" {text}"] for text in texts]
        self._learn({chunk for chunks in cut for chunk in chunks})
        nothing = (0, 0, 0, 0), "", np.empty(0, np.int64), np.empty(0, np.int64)
        for chunks in cut:
            found = [self.young[c] for c in chunks]
            if None in found:
                yield nothing
                continue
            numbers, groups, pairs = zip(*found)
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            yield tuple(map(sum, zip(*numbers))), digest, *np.unique(np.frombuffer(b"".join(pairs), np.int64), return_counts=True)


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts in runs of about ``BYTES_AT_ONCE``, each with the index of its first."""
    first, size, run = 0, 0, []
    for i, text in enumerate(texts):
        run.append(text.as_py())
        size += len(run[-1])
        if size >= BYTES_AT_ONCE or i + 1 == len(texts):
            yield first, [t.decode("utf-8", "replace") for t in run]
            first, size, run = i + 1, 0, []


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


_aligners: dict[tuple[bytes, bytes], Aligner] = {}


def _aligner(models: tuple[bytes, bytes]) -> Aligner:
    """One for all tasks of a Python worker, so that each goes on with what the tasks before have met."""
    if models not in _aligners:
        _aligners.clear()
        _aligners[models] = Aligner(*models)
    return _aligners[models]


def _aligned(models):
    """(text, n, text_id) to the columns of ``ALIGNED``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(models.value)
        for whole in batches:
            for first, texts in _slices(whole.column(0)):
                batch = whole.slice(first, len(texts))
                numbers, digests, pairs, links = zip(*aligner.align(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2), batch.column(1), *(pa.array(c, pa.int64()) for c in zip(*numbers)), pa.array(digests, pa.string()),
                     _lists(pairs, pa.int64()), _lists(links, pa.int32())],
                    names=["text_id", "n", *MEASURES, "groups_sha256", "pairs", "links"])
    return run


def _text_id(text):
    return F.unhex(F.sha2(text, 256))


def aligned_texts(docs: DataFrame, text_col: str = "text", a_model: bytes | None = None, b_model: bytes | None = None) -> DataFrame:
    """One stored row per distinct text that is neither null nor empty: its SHA-256, number of documents, measures and id pairs.

    A pair is ``a << 32 | b``. The models are the bytes of the tokenizers' files; left out, the
    driver reads ``TOKENIZER_A`` and ``TOKENIZER_B``. Executors get the bytes, and need no files.
    """
    spark = docs.sparkSession
    ship_package(spark)
    models = []
    for given, path in ((a_model, TOKENIZER_A), (b_model, TOKENIZER_B)):
        if given is None:
            with open(path, "rb") as file:
                given = file.read()
        models.append(given)
    text = F.col(text_col).cast("binary")
    distinct = docs.select(text.alias("text")).where(F.octet_length("text") > 0).groupBy("text").agg(F.count("*").alias("n"))
    aligned = distinct.select("text", "n", _text_id(F.col("text")).alias("text_id")).mapInArrow(_aligned(spark.sparkContext.broadcast(tuple(models))), ALIGNED)
    return stage(aligned, "aligned-texts")


def pair_table(aligned: DataFrame) -> DataFrame:
    """Of ``aligned_texts``, stored: pair, a, b, in how many documents the two ids are linked, and whether no other b is linked with a in more."""
    counts = stage(aligned.select("n", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("n").alias("documents")), "pair-counts")
    counts = counts.withColumns({"a": F.shiftright("pair", 32), "b": F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))})
    most = counts.groupBy("a").agg(F.max("documents").alias("_most"))
    return stage(counts.join(most, "a").select("pair", "a", "b", "documents", (F.col("documents") == F.col("_most")).alias("best")), "pairs")


def _head(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of the most documents, sorted, with that number and whether they are best: ``HEAD_PAIRS`` at most.

    They are the pairs of at least so many documents, the least such number of a fixed scale that keeps the bound.
    """
    step = F.floor(F.log2("documents") * 16)
    steps = sorted(((r.step, r["n"]) for r in pairs.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True)
    totals = list(accumulate(n for _, n in steps))
    fitting = [at for (at, _), total in zip(steps, totals) if total <= HEAD_PAIRS]
    if not fitting:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    table = pairs.where(step >= fitting[-1]).select("pair", "documents", "best").toArrow()
    pair, documents, best = (table.column(c).to_numpy() for c in table.column_names)
    order = np.argsort(pair)
    return pair[order], documents[order], best[order].astype(bool)


def _scored(head):
    """Score the pairs of the head, and hand on the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, documents, best = head.value
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(first, ROWS_AT_ONCE)
                pair_lists, links = batch.column("pairs"), batch.column("links").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = np.diff(pair_lists.offsets.to_numpy())
                pairs, row = pair_lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)
                at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
                found = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
                sums = []
                for value in (best, documents):
                    total = np.zeros(len(sizes), np.int64)
                    np.add.at(total, row[found], links[found] * value[at[found]])
                    sums.append(pa.array(total))
                rest = pa.StructArray.from_arrays([pa.array(pairs[~found], pa.int64()), pa.array(links[~found], pa.int32())], ["pair", "links"])
                ends = np.cumsum([0, *np.bincount(row[~found], minlength=len(sizes))]) if len(sizes) else np.zeros(1, int)
                kept = ["text_id", *MEASURES, "groups_sha256"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), *sums, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest)],
                    names=[*kept, "n_best", "count_sum", "rest"])
    return run


def text_measures(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per distinct text: its measures, ``n_best`` and ``count_sum``.

    Pairs of the head are looked up in a broadcast table; all others are joined by pair. The sums are the same either way.
    """
    head = aligned.sparkSession.sparkContext.broadcast(_head(pairs))
    parts = stage(aligned.select("text_id", *MEASURES, "groups_sha256", "pairs", "links").mapInArrow(_scored(head), SCORED), "text-measures")
    rest = parts.select("text_id", F.inline("rest")).join(pairs.select("pair", "documents", "best"), "pair").groupBy("text_id").agg(
        F.sum(F.col("links") * F.col("best").cast("long")).alias("_best"), F.sum(F.col("links") * F.col("documents")).alias("_sum"))
    return parts.drop("rest").join(rest, "text_id", "left").select(
        "text_id", *MEASURES, (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"), "groups_sha256")


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **models) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    Byte offsets where a token of A and one of B end cut both into groups; every A token of a group is linked with every B token
    of it. An id pair counts once for each document that holds it linked, copies included. ``n_best`` counts the
    links whose pair is the commonest of its A id (ties included), ``count_sum`` adds up the pairs' counts over links.

    Null and empty texts, and those whose bytes a tokenizer does not give back (as of texts with U+2581),
    have zeros, an empty digest and no part in the counts. Null and repeated ids are rows like any other; copies get equal rows. An empty table gives none.
    """
    aligned = aligned_texts(docs, text_col, **models)
    measures = text_measures(aligned, pair_table(aligned))
    rows = docs.select(F.col(id_col).alias("doc_id"), _text_id(F.col(text_col).cast("binary")).alias("text_id"))
    numbers = [*MEASURES, "n_best", "count_sum"]
    return rows.join(measures, "text_id", "left").select(
        "doc_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
