"""Remove passages that repeat earlier documents, located with Aho-Corasick automata.

A window is ``window`` consecutive words. Every window names one short phrase
in it, that with the smallest hash, so equal windows name equal phrases. Phrases named in two
documents are recurring; each shard of documents compiles those it holds into an automaton and
streams its texts through it. Around every occurrence the windows are compared, and only
there, so what is shuffled are phrases and windows of passages that recur, not all windows.
"""

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .base import pieces_of, ship_package, stage
from .phrase_index import _small

WINDOW = 50
PHRASE = 8
SHARD_BYTES = 2 << 20
#: Odd multipliers of the two rolling hashes, and how many words a worker remembers.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
REMEMBERED = 300_000
AT_ONCE = 1 << 18
PLACE_BITS = np.uint64((1 << 24) - 1)


class _Hashes(dict):
    """Hash of each word, remembered for the words met last."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class _Rolling:
    """Hashes of any span of a text, from running sums modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.back = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, hashes: np.ndarray) -> np.ndarray:
        n = len(hashes) + 1
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(size - 1, x, np.uint64)))) for x in (self.base, self.back))
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * self.up[:n - 1], dtype=np.uint64)))

    def spans(self, sums: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return (sums[stops] - sums[starts]) * self.down[starts]


def _scatter(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def named_phrases(hashes: np.ndarray, window: int, phrase: int):
    """Of a text's word hashes: (place, hash) of each phrase its windows name, and the first and last window that name it."""
    count = len(hashes) - phrase + 1
    grams = hashes[:count].copy()
    for i in range(1, phrase):
        grams = grams * np.uint64(BASES[0]) + hashes[i:count + i]
    grams = _scatter(grams)
    width, windows = window - phrase + 1, len(hashes) - window + 1
    places = np.concatenate([i + _least_places(grams[i:i + AT_ONCE + width - 1], width) for i in range(0, windows, AT_ONCE)])
    first = np.concatenate(([0], np.flatnonzero(np.diff(places)) + 1))
    last = np.concatenate((first[1:] - 1, [windows - 1]))
    return places[first], grams[places[first]], first, last


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` hashes the place of the smallest by its upper bits, the first of equals.

    Minima of the run's two halves, from running minima of blocks of ``width`` in both directions; the
    lower bits hold the place.
    """
    keys = (hashes & ~PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    blocks = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max)
    blocks[:len(keys)] = keys
    blocks = blocks.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(keys) - width + 1
    least = np.minimum(backward[:count], forward[width - 1:width - 1 + count])
    return (least & PLACE_BITS).astype(np.int64)


def _span_names(hashes: np.ndarray, places: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of all words under the windows that name a phrase, with their number and where it stands in them."""
    return _scatter(hashes ^ _scatter((last - first).astype(np.uint64) * np.uint64(1 << 20) + (places - first).astype(np.uint64)))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def _phrases_of_texts(window: int, phrase: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rolling = _Hashes(1), _Rolling(BASES[0])
        for batch in batches:
            docs, shards, texts = batch.columns
            out = {"phrase": [], "span": [], "row": []}
            for row, text in enumerate(texts):
                words = text.as_py().split()
                if len(words) < window:
                    continue
                hashes = known.of(words)
                places, names, first, last = named_phrases(hashes, window, phrase)
                out["phrase"].append(names)
                out["span"].append(_span_names(rolling.spans(rolling.sums(hashes), first, last + window), places, first, last))
                out["row"].append(np.full(len(places), row))
            if out["row"]:
                row = pa.array(np.concatenate(out["row"]))
                yield pa.RecordBatch.from_arrays(
                    [_signed(np.concatenate(out["phrase"])), _signed(np.concatenate(out["span"])), docs.take(row), shards.take(row)],
                    names=["phrase", "span", "doc", "shard"])
    return run


SPANS = pa.schema([("doc", pa.int64()), ("text_key", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])


def _stream(window: int, phrase: int):
    """For a shard: its texts, streamed through the automaton of the recurring phrases it holds."""

    def run(texts: pa.Table, recurring: pa.Table) -> pa.Table:
        keys = zip(recurring["phrase"].to_pylist(), recurring["span"].to_pylist())
        wanted = dict(zip(keys, zip(recurring["first"].to_pylist(), recurring["mixed"].to_pylist())))
        if not wanted or not len(texts):
            return SPANS.empty_table()
        phrases = {name for name, _ in wanted}
        known = [_Hashes(1), _Hashes(2)]
        rolling = [_Rolling(b) for b in BASES]
        automaton, held = ahocorasick.Automaton(), []
        for doc, key, text in zip(texts["doc"].to_pylist(), texts["text_key"].to_pylist(), texts["text"]):
            words = text.as_py().split()
            if len(words) < window:
                continue
            hashes = known[0].of(words)
            places, names, first, last = named_phrases(hashes, window, phrase)
            names = names.view(np.int64)
            for place, name in zip(places.tolist(), names.tolist()):
                if name in phrases:
                    text_of = (b" %b " % b" ".join(words[place:place + phrase])).decode("latin-1")
                    automaton.add_word(text_of, (name, len(text_of)))
            held.append((doc, key, words, hashes, names, places, first, last))
        if not len(automaton):
            return SPANS.empty_table()
        automaton.make_automaton()
        tables = []
        for doc, key, words, hashes, names, places, first, last in held:
            stream = (b" %b " % b" ".join(words)).decode("latin-1")
            hits = [end - size + 1 for end, (_, size) in automaton.iter(stream)]
            if not hits:
                continue
            opens = np.concatenate(([0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)))
            found = np.searchsorted(opens, np.array(hits))
            # Phrases found where no window names them say nothing about a window.
            which = np.flatnonzero(np.isin(places, found))
            low, high = first[which], last[which]
            sums = rolling[0].sums(hashes)
            spans = _span_names(rolling[0].spans(sums, low, high + window), places[which], low, high).view(np.int64)
            facts = [wanted[pair] for pair in zip(names[which].tolist(), spans.tolist())]
            # The whole span stands in an earlier document: then all its windows do.
            sure = np.array([f[0] < doc for f in facts], bool)
            open_ = np.array([f[1] for f in facts], bool) & ~sure
            parts = [(low[sure], high[sure] + window, None, None)]
            if open_.any():
                starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(low[open_].tolist(), high[open_].tolist())])
                other = rolling[1].sums(known[1].of(words))
                keys = [_signed(_scatter(r.spans(c, starts, starts + window))) for r, c in zip(rolling, (sums, other))]
                parts.append((starts, starts + window, *keys))
            for start, stop, a, b in parts:
                n = len(start)
                if n:
                    none = pa.nulls(n, pa.int64())
                    tables.append(pa.Table.from_arrays([
                        pa.array(np.full(n, doc)), pa.array(np.full(n, key)), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32)),
                        none if a is None else a, none if b is None else b], schema=SPANS))
        return pa.concat_tables(tables) if tables else SPANS.empty_table()
    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """Rows (doc, text_key, start, stop): word spans that windows of documents with smaller ids cover too.

    Spans overlap; ``text_key`` is the XXH64 of the text and tells rows of one id apart.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")).where("doc is not null and text is not null")
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    shards = pieces_of(docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0], SHARD_BYTES)
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc", "text_key"), F.lit(shards)))
    text = F.col("text").cast("binary").alias("text")

    narrow = rows.select("doc", "shard", text)
    named = narrow.mapInArrow(_phrases_of_texts(window, phrase), "phrase long, span long, doc long, shard long")
    # Once per shard first: however many documents hold a span, it has no more rows than there are shards.
    named = stage(named.groupBy("phrase", "span", "shard").agg(F.min("doc").alias("first"), F.max("doc").alias("last")), "named-phrases")
    recurring = named.groupBy("phrase").agg(F.min("first").alias("least"), F.max("last").alias("most"), (F.min("span") != F.max("span")).alias("mixed"))
    recurring = stage(recurring.where("least < most").select("phrase", "mixed"), "recurring-phrases")
    # Of a span the first document is known at once; windows are compared only where one phrase stands in different spans.
    held = stage(named.select("phrase", "span", "shard", "first").join(recurring, "phrase"), "recurring-spans")
    firsts = stage(held.groupBy("phrase", "span").agg(F.min("first").alias("first")), "first-spans")
    wanted = held.drop("first").join(firsts, ["phrase", "span"])

    streamed = rows.select("shard", "doc", "text_key", text).groupBy("shard").cogroup(wanted.groupBy("shard"))
    spans = stage(streamed.applyInArrow(_stream(window, phrase), "doc long, text_key long, start int, stop int, a long, b long"), "spans")

    windows = spans.where("a is not null")
    earliest = windows.groupBy("a", "b").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").drop("last")
    earliest = stage(earliest, "repeated-windows")
    later = windows.join(earliest, ["a", "b"]).where("doc > first").select("doc", "text_key", "start", "stop")
    return spans.where("a is null").select("doc", "text_key", "start", "stop").unionByName(later)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, counts, removed = [], [], []
        for text, spans in zip(batch.column("_text"), batch.column("_spans")):
            words = (text.as_py() or b"").split()
            counts.append(len(words))
            if spans.is_valid:
                edges = np.zeros(len(words) + 1, np.int64)
                flat = spans.values
                np.add.at(edges, flat.field("start").to_numpy(), 1)
                np.add.at(edges, flat.field("stop").to_numpy(), -1)
                stay = np.cumsum(edges[:-1]) == 0
                words = [w for w, s in zip(words, stay.tolist()) if s]
            removed.append(counts[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
            names=[*batch.schema.names[:-2], "n_words", "n_removed", "_kept"])


def _merged(spans: Column) -> Column:
    """Sorted spans with those that touch or overlap made one."""
    nothing = F.array().cast("array<struct<start:int,stop:int>>")
    return F.aggregate(spans, nothing, lambda done, s: F.when(
        (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["stop"] >= s["start"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.get(done, F.size(done) - 1)["start"].alias("start"), F.greatest(F.get(done, F.size(done) - 1)["stop"], s["stop"]).alias("stop")))),
    ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and kept, the words that stay, joined by one space.

    A word goes if a window over it starts in a document with a smaller id too; windows are
    those of the input. Null texts have no words. A row without id is left as it is, and proves nothing
    about others; rows with equal ids prove nothing about each other. Exact copies
    lose every word if they hold a window at all.
    """
    spans = repeated_spans(docs, id_col, text_col, window, phrase)
    spans = spans.groupBy("doc", "text_key").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("_all"))
    spans = stage(spans.select("doc", "text_key", _merged(F.col("_all")).alias("_spans")), "removed-spans")
    spans = _small(spans, F.size("_spans") * 8 + 40)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("text_key"), text.cast("binary").alias("_text"))
    rows = rows.join(spans, ["doc", "text_key"], "left").select("doc_id", "_text", "_spans")
    out = rows.select("doc_id").schema.add("n_words", "long").add("n_removed", "long").add("_kept", "binary")
    return rows.mapInArrow(_cut, out).withColumn("kept", F.col("_kept").cast("string")).drop("_kept")


def passage_digests(docs: DataFrame, **options) -> DataFrame:
    """``remove_repeats`` with the SHA-256 of the kept words in their place."""
    return remove_repeats(docs, **options).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: The same rows, every window of every document compared.
ORACLE = r"""
with doc as (
  select doc_id, row_number() over () as r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), win as (
  select doc_id, r, i, array_to_string(list_slice(w, i, i + 49), ' ') as win
  from (select doc_id, r, w, unnest(range(1, len(w) - 48)) as i from doc where len(w) >= 50)
), earliest as (select win, min(doc_id) as first from win group by win),
gone as (select distinct r, q from (select r, unnest(range(i, i + 50)) as q from win join earliest using (win) where doc_id > first)),
word as (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as q from doc),
kept as (select r, string_agg(word, ' ' order by q) as kept, count(*) as n from word anti join gone using (r, q) group by r)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from doc left join kept using (r)
"""
