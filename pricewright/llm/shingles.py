"""Texts that share most of their word shingles, found by MinHash and checked by the shingles themselves."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .base import kept, ship_package, stage
from .components import components

SHINGLE = 5
#: Texts are alike if at least so many of their shingles (a fraction) are common to both.
ALIKE = (4, 5)
#: Two texts as little alike as that meet in one of the bands with a chance of 1 - (1 - 0.8^8)^40 = 0.9994; at 0.5 it is 0.15.
BANDS, HASHES = 40, 8
#: Shingles hashed together and texts sent together, so that long texts need no more memory.
AT_ONCE, TEXTS_AT_ONCE = 4096, 256
#: So many pairs with one leader share a copy of its shingles, in a key of their own.
PAIRS_PER_COPY = 128
#: Of a bucket so many members are held in memory at most on average, while so many others at most pass by.
HELD, PASSING = 64, 4096
SEED = 42

_draw = np.random.default_rng(SEED)
_ADDENDS = _draw.integers(0, 1 << 64, (BANDS * HASHES, 1), np.uint64)
_FACTORS = _draw.integers(0, 1 << 64, (BANDS * HASHES, 1), np.uint64) | np.uint64(1)


def shingles(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of a text's word shingles, sorted; a shorter text is one shingle, one without words has none."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    found = {digest(b" ".join(words[i:i + shingle]), SEED) for i in range(max(1, len(words) - shingle + 1))}
    return np.array(sorted(found), np.uint64)


def bands(hashes: np.ndarray) -> list[int]:
    """One signed number per band of minima; none for a text without shingles."""
    if not len(hashes):
        return []
    least = np.full(BANDS * HASHES, (1 << 64) - 1, np.uint64)
    for first in range(0, len(hashes), AT_ONCE):
        mixed = hashes[None, first:first + AT_ONCE] * _FACTORS
        mixed += _ADDENDS
        least = np.minimum(least, mixed.min(axis=1))
    rows = least.astype("<u8").reshape(BANDS, HASHES)
    return [xxhash.xxh64_intdigest(row.tobytes(), i) - (1 << 63) for i, row in enumerate(rows)]


def text_id(text: Column) -> Column:
    return F.unhex(F.md5(text))


def with_signature(rows: DataFrame, fingerprint: Callable[[bytes | None], int]) -> DataFrame:
    """``rows`` with ``_fp``, ``_size`` (distinct shingles) and ``_bands`` in place of the last column, the text: one pass over the texts."""
    ship_package(rows.sparkSession)
    names = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(first, TEXTS_AT_ONCE)
                texts = batch.column(batch.num_columns - 1).to_pylist()
                sets = [shingles(text) for text in texts]
                prints = np.array([fingerprint(text) for text in texts], np.uint64).view(np.int64)
                made = [pa.array(prints), pa.array(map(len, sets), pa.int32()), pa.array(map(bands, sets), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*names, "_fp", "_size", "_bands"])

    schema = rows.select(*names).schema.add("_fp", "long").add("_size", "integer").add("_bands", T.ArrayType(T.LongType()))
    return rows.mapInArrow(run, schema)


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for first in range(0, whole.num_rows, TEXTS_AT_ONCE):
            row, texts = whole.slice(first, TEXTS_AT_ONCE).columns
            made = pa.array([shingles(t.as_py()).view(np.int64) for t in texts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([row, made], names=["row", "set"])


def _starred(members: DataFrame) -> DataFrame:
    """Pairs (a, b, n) of a bucket's first and another of its n members, each once, that are not too unlike in size to be alike."""
    part, whole = ALIKE
    first = members.where(F.col("row") == F.col("first")).select("band", F.col("row").alias("a"), F.col("size").alias("a_size"), F.col("node").alias("a_node"))
    pairs = members.join(first, "band").where((F.col("row") != F.col("a")) & (F.col("node") != F.col("a_node")))
    pairs = pairs.where(F.least("size", "a_size") * whole >= F.greatest("size", "a_size") * part)
    return pairs.groupBy("a", F.col("row").alias("b")).agg(F.max("n").alias("n"))


def _passed_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (band, chunk, piece, passes, row, root, outside, set), those of a group together and the held ones first, to the pairs (a, b) that are alike."""
    part, whole = ALIKE
    at, held, table = None, [], None
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("band", "chunk", "piece")))
        facts = zip(keys, *(batch.column(c).to_pylist() for c in ("passes", "row", "root", "outside")), batch.column("set"))
        found = []
        for key, passes, row, root, outside, shingle_set in facts:
            if key != at:
                at, held, table = key, [], None
            mine = shingle_set.values.to_numpy()
            if not passes:
                held.append((row, root, mine))
                continue
            if not held:
                continue
            if table is None:
                rows, roots, sets = zip(*held)
                sizes = np.array([len(x) for x in sets])
                table = np.array(rows), np.array(roots), sizes, np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            rows, roots, sizes, flat, owner = table
            common = np.bincount(owner[np.isin(flat, mine)], minlength=len(rows))
            # Of two that are both held once each passes by the other.
            alike = (common * (part + whole) >= (sizes + len(mine)) * part) & (roots != root) & ((rows < row) | (not outside))
            found += [(int(x), row) for x in rows[alike]]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], names=["a", "b"])


def _compared(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The alike pairs (a, b) of members outside their bucket's largest component and members of other components.

    Members outside are dealt to chunks, which are held, and all members to pieces, which pass by every chunk of their bucket;
    pairs are compared where they meet, and only those that are alike leave the task.
    """
    pieces = F.ceil(F.col("n") / PASSING).cast("long")
    chunks = F.ceil(F.col("outside") / HELD).cast("long")
    outer = F.col("root") != F.col("top.root")
    every = lambda number: F.explode(F.sequence(F.lit(0).cast("long"), number - 1))
    facts = ["row", "root", outer.alias("outside")]
    holds = members.where(outer).select("band", F.pmod(F.xxhash64("row"), chunks).alias("chunk"), every(pieces).alias("piece"), F.lit(False).alias("passes"), *facts)
    passes = members.select("band", every(chunks).alias("chunk"), F.pmod(F.xxhash64("row", F.lit(1)), pieces).alias("piece"), F.lit(True).alias("passes"), *facts)
    rows = holds.unionByName(passes).join(sets, "row").select("band", "chunk", "piece", "passes", "row", "root", "outside", "set")
    key = ["band", "chunk", "piece"]
    return rows.repartition(*key).sortWithinPartitions(*key, "passes").mapInArrow(_passed_by, "a long, b long")


def _links(alike: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of rows as pairs of their nodes, stored."""
    nodes = texts.select("row", "node")
    ends = stage(alike, "alike-rows").join(nodes.select(F.col("row").alias("b"), F.col("node").alias("b_node")), "b")
    ends = ends.join(nodes.select(F.col("row").alias("a"), F.col("node").alias("a_node")), "a")
    return stage(ends.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).where("a != b").distinct(), "alike")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are alike.

    A leader of a large bucket has many pairs; they are dealt to as many copies of its shingles as that takes.
    """
    level = F.ceil(F.log2(F.greatest(F.col("n") / PAIRS_PER_COPY, F.lit(1)))).cast("int")
    pairs = pairs.withColumn("level", level)
    heads = pairs.select("a", "level").distinct().join(sets.select(F.col("row").alias("a"), F.col("set").alias("a_set")), "a")
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.expr("shiftleft(1L, level) - 1")))
    heads = heads.select("a", "level", "a_set", copy.alias("copy"))
    dealt = pairs.withColumn("copy", F.pmod(F.xxhash64("b"), F.expr("shiftleft(1L, level)")))
    tails = sets.select(F.col("row").alias("b"), F.col("set").alias("b_set"))
    common = F.size(F.array_intersect("a_set", "b_set"))
    part, whole = ALIKE
    enough = common * (part + whole) >= (F.size("a_set") + F.size("b_set")) * part
    return dealt.join(heads, ["a", "level", "copy"]).join(tails, "b").where(enough).select("a", "b")


def alike_roots(rows: DataFrame, sources: DataFrame, links: DataFrame) -> DataFrame:
    """Rows (node, root): the components of ``links`` (a, b) and of the links between nodes with texts that are alike.

    ``rows`` is stored, with ``_id``, ``_text_id``, ``_fp`` (the node), ``_size`` and ``_bands``; ``sources`` holds ``_id``, ``_text_id`` and ``_text``.

    Texts that agree in one band of minima meet in its bucket; of buckets with the same texts one is kept. Each text is first compared with the bucket's
    first. A pair that is not linked by then has a member outside the bucket's largest component, so
    when all of these have been compared with the members of other components, no pair of the bucket is left out. A bucket of copies costs no
    more than its size; of one with many members that are alike to few others the rows that move are its size times its chunks of ``HELD``.
    """
    links = stage(links.select("a", "b").distinct(), "near-links")
    texts = rows.where("_text_id is not null and _size > 0").groupBy("_text_id").agg(
        F.min("_id").alias("_id"), F.first("_fp").alias("node"), F.first("_size").alias("size"), F.first("_bands").alias("bands"))
    texts = stage(texts.withColumn("row", F.monotonically_increasing_id()), "distinct-texts")
    filed = texts.select("row", F.explode("bands").alias("band"))
    buckets = filed.groupBy("band").agg(F.count("*").alias("n"), F.min("row").alias("first"), F.bit_xor(F.xxhash64("row")).alias("all")).where("n > 1")
    buckets = buckets.groupBy("n", "first", "all").agg(F.min("band").alias("band")).drop("all")
    met = stage(filed.join(buckets, "band"), "band-members")
    met = stage(met.join(texts.select("row", "node", "size"), "row"), "sized-members")

    needed = met.select("row").distinct().join(texts.select("row", "_id", "_text_id"), "row")
    same = needed["_id"].eqNullSafe(sources["_id"]) & (needed["_text_id"] == sources["_text_id"])
    wanted = sources.join(needed, same).groupBy("row").agg(F.first("_text").alias("text"))
    sets = stage(wanted.mapInArrow(_shingle_sets, "row long, set array<long>"), "shingle-sets")

    links = links.unionByName(_links(_verified(_starred(met), sets), texts))
    roots = kept(rows.sparkSession, "component-roots", lambda: components(links))
    rooted = stage(met.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted-members")
    sizes = rooted.groupBy("band", "root").agg(F.count("*").alias("size"))
    tops = sizes.groupBy("band").agg(F.max(F.struct("size", "root")).alias("top"), (F.sum("size") - F.max("size")).alias("outside")).where("outside > 0")
    mixed = stage(rooted.join(tops, "band"), "mixed-members")
    found = _links(_compared(mixed, sets), texts)
    return roots if found.isEmpty() else kept(rows.sparkSession, "component-roots", lambda: components(links.unionByName(found)))
