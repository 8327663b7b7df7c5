"""Compress vectors to codes: each part of a vector becomes the index of its nearest codebook entry.

The nearest entry is found by the equal-average search: entries sorted by the
sum of their components are visited outward from the part's own sum, and those whose
sum differs too much to be nearer are never compared.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .base import ship_package, stage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Scaled components are held within this size, so that no squared distance of a vector passes 64 bits.
LARGEST = 1 << 27
ROWS_AT_ONCE = 1024


def nearest_entries(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each row of ``parts``: the index of the nearest row of ``book`` (ties to the lower), the squared distance; and how many pairs were compared.

    By the inequality of Cauchy and Schwarz the squared difference of two sums, over the dimension, is no more than
    the squared distance; so a side ends once that strictly exceeds the best distance found.
    """
    size, dims = book.shape
    sums, own = book.sum(axis=1), parts.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    ordered, sums = book[order], sums[order]
    best, at = np.full(len(parts), np.iinfo(np.int64).max), np.full(len(parts), size)
    right = np.searchsorted(sums, own)
    left, open_rows, compared = right - 1, np.arange(len(parts)), 0
    far = np.iinfo(np.int64).max
    while len(open_rows):
        low, high, mine = left[open_rows], right[open_rows], own[open_rows]
        low_gap = np.where(low >= 0, mine - sums[np.maximum(low, 0)], far)
        high_gap = np.where(high < size, sums[np.minimum(high, size - 1)] - mine, far)
        go_left = low_gap <= high_gap
        gap = np.where(go_left, low_gap, high_gap)
        # Both sides are used up, or the nearer one is out of reach. Doubles only leave out what is out of reach by more than their rounding.
        reach = (gap != far) & (gap.astype(float) ** 2 / dims <= best[open_rows] * (1 + 1e-9))
        open_rows, entry, go_left = open_rows[reach], np.where(go_left, low, high)[reach], go_left[reach]
        difference = parts[open_rows] - ordered[entry]
        distance, index = np.einsum("ij,ij->i", difference, difference), order[entry]
        compared += len(open_rows)
        better = (distance < best[open_rows]) | ((distance == best[open_rows]) & (index < at[open_rows]))
        best[open_rows[better]], at[open_rows[better]] = distance[better], index[better]
        left[open_rows] -= go_left
        right[open_rows] += ~go_left
    return at, best, compared


def _vectors(batch: pa.RecordBatch, first: int, dims: int) -> np.ndarray:
    flat = batch.column("_vector").slice(first, ROWS_AT_ONCE).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _cell_sums(books, dims: int):
    """Per task one row for each touched cell: for every entry the sum of each component over the parts assigned to it, and their count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = books.value
        parts, size, width = entries.shape
        sums = np.zeros((parts, size, width + 1), np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                vectors = _vectors(batch, first, dims).reshape(-1, parts, width)
                for p in range(parts):
                    at, _, _ = nearest_entries(vectors[:, p], entries[p])
                    np.add.at(sums[p], at, np.pad(vectors[:, p], ((0, 0), (0, 1)), constant_values=1))
        flat = sums.ravel()
        cells = np.flatnonzero(np.repeat(sums[:, :, -1].ravel() > 0, width + 1))
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(flat[cells])], names=["cell", "total"])
    return run


def _codes(books, dims: int, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = books.value
        parts, size, width = entries.shape
        for batch in batches:
            codes, errors = [], []
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                vectors = _vectors(batch, first, dims).reshape(-1, parts, width)
                at, error = zip(*(nearest_entries(vectors[:, p], entries[p])[:2] for p in range(parts)))
                codes += ["".join(f"{x:02x}" for x in row) for row in np.stack(at, axis=1)]
                errors += np.sum(error, axis=0, dtype=np.int64).tolist()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=[*keep, "code", "error"])
    return run


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """The components times ``scale``, floored; null for a vector that is null or holds null or non-finite components."""
    number = lambda x: x.cast("double")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(number(x)) & (F.abs(number(x)) < float("inf")))
    held = F.transform(vector, lambda x: F.least(F.greatest(F.floor(F.least(F.greatest(number(x), F.lit(-1e9)), F.lit(1e9)) * scale), F.lit(-LARGEST)), F.lit(LARGEST)).cast("int"))
    return F.when(F.coalesce(sound, F.lit(False)), held)


def usable(vectors: DataFrame, id_col: str, vector_col: str, keep: list[Column], scale: int = SCALE) -> tuple[DataFrame, int]:
    """The columns ``keep`` and ``_vector`` of the rows that take part, and the vectors' length (0 without rows).

    The length is the commonest one, the greatest of several.
    """
    rows = vectors.select(F.col(id_col).alias("_id"), *keep, scaled(F.col(vector_col), scale).alias("_vector")).where("_vector is not null")
    lengths = rows.groupBy(F.size("_vector").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    dims = lengths[0].dims if lengths else 0
    return rows.where(F.size("_vector") == dims), dims


def fit_codebooks(rows: DataFrame, dims: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks as an array (part, entry, component), from rows with ``_id`` and ``_vector``.

    They start as the parts of the rows with the smallest ids (null last, ties by vector); every round moves each entry to the floored mean of the
    parts it is nearest to, and leaves unused ones. A round is one pass whose tasks hand on one sum per cell
    of the codebooks, so what is shuffled and what reaches the driver is bounded by the codebooks' size.
    """
    if dims % parts:
        raise ValueError(f"vectors of {dims} components cannot be cut into {parts} equal parts")
    spark = rows.sparkSession
    first = rows.orderBy(F.col("_id").asc_nulls_last(), "_vector").limit(entries).select("_vector").collect()
    books = np.array([r["_vector"] for r in first], np.int64).reshape(len(first), parts, dims // parts).transpose(1, 0, 2)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(np.ascontiguousarray(books))
        sums = rows.select("_vector").mapInArrow(_cell_sums(shared, dims), "cell long, total long")
        found = np.zeros((parts, len(first), dims // parts + 1), np.int64)
        for cell in sums.groupBy("cell").agg(F.sum("total").alias("total")).collect():
            found.reshape(-1)[cell.cell] = cell.total
        used = found[:, :, -1] > 0
        books = books.copy()
        books[used] = found[used][:, :-1] // found[used][:, -1:]
        shared.unpersist()
    return np.ascontiguousarray(books)


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(rows: DataFrame, books: np.ndarray, dims: int, keep: list[str]) -> DataFrame:
    """The columns ``keep``, the code (two hex digits per part) and the squared distance of the vector from what its code stands for."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    narrow = rows.select(*keep, "_vector")
    schema = narrow.drop("_vector").schema.add("code", "string").add("error", "long")
    return narrow.mapInArrow(_codes(shared, dims, keep), schema)


def decode(code: str, books: np.ndarray) -> list[int]:
    """The scaled vector that a code stands for."""
    return [int(x) for p in range(len(books)) for x in books[p, int(code[2 * p:2 * p + 2], 16)]]


def compress_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                     parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Per row that takes part: vec_id, code, error, label_error (the errors of all rows with an equal label) and codebooks_sha256.

    Rows whose vector is null or holds null or non-finite components are left out, as are vectors of another length than the commonest.
    Components beyond 2^19 in size count as that, since distances must fit 64 bits. Null labels are one label; null and repeated
    ids are rows like any other, and of rows with equal ids the smaller vector comes first into the codebook.
    With fewer rows than ``entries`` the codebooks are that short. No row gives no row. ``entries`` is 256 at most.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits per part")
    ship_package(vectors.sparkSession)
    rows, dims = usable(vectors, id_col, vector_col, [F.col(label_col).alias("_label")])
    if not dims:
        kind = rows.schema["_id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string")
    books = fit_codebooks(rows, dims, parts, entries, rounds)
    coded = stage(encode(rows, books, dims, ["_id", "_label"]), "vector-codes")
    errors = coded.groupBy(F.col("_label").alias("_of")).agg(F.sum("error").alias("label_error"))
    return coded.join(errors, F.col("_label").eqNullSafe(F.col("_of"))).select(
        F.col("_id").alias("vec_id"), "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


#: The same by comparing every part with every entry.
ORACLE = """
    with kept as (
      select vec_id, label, [cast(floor(256 * x::double) as bigint) for x in embedding] as v from embeddings
      where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
    numbered as (select *, row_number() over () as n from kept),
    cut as (select n, vec_id, label, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] as part from numbered, range(16) as r(p)),
    book0 as (
      select p, e, part as entry from (select *, row_number() over (partition by p order by vec_id, part) - 1 as e from cut) where e < 64),
    {rounds}
    far as (
      select n, p, min({distance}) as error, arg_min(e, {distance} * 64 + e) as e from cut join book2 using (p) group by n, p),
    coded as (select n, string_agg(lower(lpad(to_hex(e), 2, '0')), '' order by p) as code, cast(sum(error) as bigint) as error from far group by n),
    digest as (select sha256(string_agg(array_to_string(entry, ','), ',' order by p, e)) as codebooks_sha256 from book2)
    select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
    from coded join numbered using (n), digest"""

_DISTANCE = "list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(part, entry)])::bigint"
_ROUND = """
    near{i} as (select n, p, any_value(part) as part, arg_min(e, {distance} * 64 + e) as e from cut join book{j} using (p) group by n, p),
    sum{i} as (
      select p, e, list(m order by c) as moved from (
        select p, e, c, cast(floor(sum(part[c])::hugeint / count(*)) as bigint) as m from near{i}, range(1, 1 + (select max(len(part)) from cut)) as r(c) group by p, e, c)
      group by p, e),
    book{i} as (select p, e, coalesce(moved, entry) as entry from book{j} left join sum{i} using (p, e)),"""
ORACLE = ORACLE.format(distance=_DISTANCE, rounds="".join(_ROUND.format(i=i, j=i - 1, distance=_DISTANCE) for i in (1, 2)))
