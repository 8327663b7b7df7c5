"""Near duplicates by SimHash, found with multi-index hashing.

Fingerprints are made in Arrow batches; everything between fingerprints is
DataFrame functions.
"""

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .base import fresh, kept, ship_package, stage
from .components import components
from .shingles import alike_roots, text_id, with_signature

SEED = 42
SHINGLE = 3
BITS = 64
#: Shingles whose bits are counted together, so that a very long text needs no more memory.
AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a UTF-8 text as an unsigned number; 0 for null and for a text without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda end, size: end + 1 + size))
    starts = [0, *(end + 1 for end in ends[:-1])]
    stops = ends[shingle - 1:] or ends[-1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for first in range(0, len(stops), AT_ONCE):
        spans = zip(starts[first:first + AT_ONCE], stops[first:first + AT_ONCE])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = (2 * ones > len(stops)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str, out: str, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` and the fingerprint of ``text_col`` as a signed long."""
    ship_package(docs.sparkSession)
    (text,) = fresh(docs.select(*keep), "text")
    narrow = docs.select(*keep, F.col(text_col).cast("binary").alias(text))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            values = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(text)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values.view(np.int64))], names=[*keep, out])

    schema = narrow.drop(text).schema.add(out, "long")
    return narrow.mapInArrow(batches, schema)


def _flips(value: Column, width: int, only_up: bool) -> Column:
    """``value`` and the numbers that differ from it in one of ``width`` bits."""
    masks = F.array(*[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long") for i in range(width)])
    if only_up:
        masks = F.filter(masks, lambda m: value.bitwiseAND(m) == 0)
    return F.concat(F.array(value), F.transform(masks, lambda m: value.bitwiseXOR(m)))


def near_pairs(prints: DataFrame, fp: str = "fp", crowded: int = 64) -> DataFrame:
    """Links (a, b) between distinct fingerprints at 2 or fewer differing bits.

    ``prints`` holds every fingerprint once. Each is filed under its two
    segments of 32 bits. Two fingerprints at distance 2 differ in at most one bit
    of one segment, so the ball of radius 1 around a segment fetches every partner;
    a pair one bit apart is fetched only from the side that lacks the bit. Whole
    distances are then compared.

    A segment value with more than ``crowded`` entries would fetch the square of
    their number. Fingerprints in such a bucket, or one bit from it, take the whole
    fingerprint as the only segment: each is filed under the 65 numbers
    of its ball of radius 1, and two meet in a ball exactly if they differ
    in 2 bits at most. At most 65 fingerprints meet in one ball, and there they
    are linked as a star. Pairs that meet only through a star's centre are linked through it.
    """
    value = F.col(fp)
    segments = F.array(
        F.struct(F.lit(0).alias("seg"), F.shiftrightunsigned(value, 32).alias("part")),
        F.struct(F.lit(1).alias("seg"), value.bitwiseAND(F.lit(0xFFFFFFFF)).alias("part")),
    )
    filed = prints.select(value.alias("fp"), F.inline(segments))
    full = filed.groupBy("seg", "part").count().where(F.col("count") > crowded).select("seg", "part")
    zone = full.select("seg", F.col("part").alias("_full"), F.explode(_flips(F.col("part"), 32, False)).alias("part"))
    zone = stage(zone.groupBy("seg", "part").agg(F.max(F.col("part") == F.col("_full")).alias("full")), "crowded-segments")
    marked = stage(filed.join(zone, ["seg", "part"], "left"), "segments")

    table = marked.where("not coalesce(full, false)")
    probes = table.select("seg", F.col("fp").alias("a"), F.col("part").alias("own"), F.explode(_flips(F.col("part"), 32, True)).alias("part"))
    met = probes.join(table.select("seg", "part", F.col("fp").alias("b")), ["seg", "part"])
    met = met.where((F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2) & ((F.col("own") != F.col("part")) | (F.col("a") < F.col("b"))))

    near_full = marked.where("full is not null").select("fp").distinct()
    balls = near_full.select("fp", F.explode(_flips(F.col("fp"), BITS, False)).alias("centre"))
    stars = balls.groupBy("centre").agg(F.collect_list("fp").alias("all")).where(F.size("all") > 1)
    stars = stars.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a != b")
    return met.select("a", "b").unionByName(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    crowded: int = 64, extra: list[Column] | None = None, alike: bool = False) -> DataFrame:
    """Per row of ``docs``: ``_id``, ``_fp`` (signed), ``_group`` and ``_low``, the smallest id of the group.

    With ``alike`` texts that share four fifths of their 5-word shingles are linked too, however far apart their fingerprints are.
    Null texts and texts without words have fingerprint 0 and are linked like others.
    Rows with equal ids are rows of their own; a null id never is a smallest id unless its group has no other.
    """
    extra = extra or []
    ids = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *extra)
    own = [c for c in ids.columns if c != "_text"]
    if alike:
        sources = ids.select(*own, F.col("_text").cast("binary").alias("_text")).withColumn("_text_id", text_id(F.col("_text")))
        signed = stage(with_signature(sources.select(*own, "_text_id", "_text"), lambda text: fingerprint(text, shingle)), "signatures")
        rows = signed.select(*own, "_fp")
    else:
        rows = stage(with_fingerprint(ids, "_text", "_fp", own, shingle), "fingerprints")
    prints = stage(rows.groupBy(F.col("_fp").alias("fp")).agg(F.min("_id").alias("low")), "distinct-fingerprints")
    pairs = near_pairs(prints, crowded=crowded)
    roots = alike_roots(signed, sources.select("_id", "_text_id", "_text"), pairs) if alike else components(pairs)
    grouped = stage(prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "roots")
    lows = stage(grouped.groupBy("root").agg(F.min("low").alias("_low")), "lows")
    groups = stage(grouped.join(lows, "root").select(F.col("fp").alias("_fp"), F.col("root").alias("_group"), "_low"), "groups")
    return rows.join(groups, "_fp")


def simhash_groups(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits) and component_id."""
    rows = near_duplicates(docs, **options)
    return rows.select(
        F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), F.col("_low").alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay when one of each group does: that with the smallest id.

    Among equal ids the smallest text digest decides; of rows equal in both one stays,
    the smallest by all columns.
    """
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)

    def choose() -> DataFrame:
        rows = near_duplicates(docs, id_col, text_col, extra=[digest.alias("_digest")], **options)
        first = rows.groupBy("_group").agg(F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_digest")).alias("_first"))
        first = first.select("_first._id", "_first._digest")
        copies = rows.groupBy("_id", "_digest").agg(F.count("*").alias("_n"))
        same = first["_id"].eqNullSafe(copies["_id"]) & (first["_digest"] == copies["_digest"])
        return first.join(copies, same).select(first["_id"], first["_digest"], "_n")

    chosen = kept(docs.sparkSession, "kept", choose)
    (mine,) = fresh(docs, "_own_digest")
    whole = docs.withColumn(mine, digest)
    whole = whole.join(chosen, whole[id_col].eqNullSafe(chosen["_id"]) & (whole[mine] == chosen["_digest"]))
    once = whole.where("_n = 1").select(*docs.columns)
    again = whole.where("_n > 1").groupBy("_id", "_digest").agg(F.min(F.struct(*[whole[c] for c in docs.columns])).alias("_row"))
    return once.unionByName(again.select("_row.*"))
