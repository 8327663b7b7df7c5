"""Put rows into shards by jump consistent hashing: no table of the ring, and a new shard takes only the rows it needs.

All of it is DataFrame functions.
"""

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewright.functions.hashing import HASH_BITS, hash52
from pricewright.operators.barrier import with_once

from .base import fresh, pieces_of, stage

#: The multiplier of the method's generator of pseudorandom numbers, modulo 2**64.
MULTIPLIER = 2862933555777941757
SEED = 42
ROWS_PER_BUCKET, COPIES_AT_ONCE = 65_536, 4096
MASK = (1 << 32) - 1


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """``MULTIPLIER`` times a 64-bit number plus 1, modulo 2**64, in halves of 32 bits so that no product passes a long."""
    m0, m1, m_high = MULTIPLIER & 0xFFFF, MULTIPLIER >> 16 & 0xFFFF, MULTIPLIER >> 32
    middle = low * _long(m1)
    least = low * _long(m0) + F.shiftleft(middle.bitwiseAND(_long(0xFFFF)), 16) + _long(1)
    most = F.shiftright(least, 32) + F.shiftright(middle, 16) + low * _long(m_high) + high * _long(m0)
    most = most + F.shiftleft((high * _long(m1)).bitwiseAND(_long(0xFFFF)), 16)
    return most.bitwiseAND(_long(MASK)), least.bitwiseAND(_long(MASK))


def jump(key: Column, shards: int) -> Column:
    """Struct (shard, next) of a key from 0 to 2**63-1: its shard of ``shards``, and how many shards there may be until it moves.

    It stays while there are ``next`` shards or fewer, and with one more it moves into that last one. The jumps of a key go
    up, about ln(shards) of them; the rare key with more than the first pass takes makes the others in a second one.
    """
    def leap(state: Column, _: Column) -> Column:
        def moved(high: Column, low: Column) -> Column:
            draw = F.shiftright(high, 1) + _long(1)
            to = F.floor((state["next"] + _long(1)).cast("double") * (F.lit(float(1 << 31)) / draw.cast("double")))
            return F.struct(high.alias("high"), low.alias("low"), state["next"].alias("shard"), to.alias("next"))

        return F.when(state["next"] >= shards, state).otherwise(moved(*_next(state["high"], state["low"])))

    start = F.struct(F.shiftright(key, 32).alias("high"), key.bitwiseAND(_long(MASK)).alias("low"), _long(-1).alias("shard"), _long(0).alias("next"))
    usual = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, 10 + 3 * math.ceil(math.log(shards + 1))))), start, leap)
    whole = F.aggregate(F.array(usual), start, lambda _, state: F.when(state["next"] >= shards, state).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.lit(shards)), state, leap)))
    return F.aggregate(F.array(whole), F.struct(F.lit(0).alias("shard"), _long(0).alias("next")),
                       lambda _, state: F.struct(state["shard"].cast("int").alias("shard"), state["next"].alias("next")))


def shard_key(column: Column, seed: int = SEED) -> Column:
    """A key of 52 bits for any value that can be written as text; null has one too."""
    return F.coalesce(hash52(seed, column), _long(0))


def with_shard(df: DataFrame, shards: int, key_col: str = "doc_id", seed: int = SEED, shard: str = "shard", following: str = "next_shards") -> DataFrame:
    """Add a row's shard, which its key and ``shards`` alone decide, and the number of shards beyond which it moves. A narrow step."""
    if not 1 <= shards < 1 << 31:
        raise ValueError("there must be between 1 and 2**31 - 1 shards")
    key, found = fresh(df, "_key", "_found")
    df = with_once(df, **{key: shard_key(F.col(key_col), seed)})
    df = with_once(df, **{found: jump(F.col(key), shards)})
    return df.withColumns({shard: F.col(found)["shard"], following: F.col(found)["next"]}).drop(key, found)


def moving_rows(df: DataFrame, before: int, after: int, key_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    """The rows that change their shard when ``before`` shards grow to ``after``, with ``shard`` and ``new_shard``."""
    (following,) = fresh(df, "_following")
    moving = with_shard(df, before, key_col, seed, "shard", following).where(F.col(following) < after).drop(following)
    return with_shard(moving, after, key_col, seed, "new_shard", following).drop(following)


def with_slot(df: DataFrame, by: list[str], shard: str = "shard", copies: str | None = None, seed: int = SEED, slot: str = "slot") -> DataFrame:
    """Add each row's place in its shard, from 0 without gaps, in a pseudorandom order that the columns ``by`` decide.

    Rows are numbered within buckets of their hash, from what the buckets before hold; one shuffle moves the rows, and no
    task holds a shard. A row with ``copies`` takes so many places, of which ``slot`` is the first. ``df`` is read twice. Columns
    ``by`` must be such that can be written as text and ordered; rows equal in all of them are interchangeable.
    """
    hashed, bucket, before, inside = fresh(df, "_hashed", "_bucket", "_before", "_inside")
    amount = F.col(copies) if copies else _long(1)
    written = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in by])
    df = with_once(df, **{hashed: hash52(seed, written)})
    counts = df.groupBy(shard).agg(F.count("*").alias("n"))
    most = counts.agg(F.max("n")).first()[0] or 0
    bits = (pieces_of(most, ROWS_PER_BUCKET) - 1).bit_length()
    df = df.withColumn(bucket, F.shiftright(hashed, HASH_BITS - bits) if bits else _long(0))
    sizes = df.groupBy(shard, bucket).agg(F.sum(amount).alias(inside))
    earlier = Window.partitionBy(shard).orderBy(bucket)
    sizes = sizes.select(shard, bucket, (F.sum(inside).over(earlier) - F.col(inside)).alias(before))
    here = Window.partitionBy(shard, bucket).orderBy(hashed, *by)
    place = F.sum(amount).over(here.rowsBetween(Window.unboundedPreceding, 0)) - amount
    return df.withColumn(inside, place).join(sizes, [shard, bucket]).withColumn(slot, F.col(before) + F.col(inside)).drop(hashed, bucket, before, inside)


def write_shards(docs: DataFrame, path: str, shards: int, key_col: str = "doc_id", seed: int = SEED, rows_per_file: int = 1_000_000) -> None:
    """Write ``docs`` as Parquet, one folder ``shard=...`` per shard, in files of about ``rows_per_file`` rows.

    The texts move once. A shard's rows are spread over as many tasks as it needs, so a hot key or shard is no single task.
    """
    (piece,) = fresh(docs, "_piece")
    placed = with_shard(docs, shards, key_col, seed, "shard", piece).drop(piece)
    pieces = pieces_of(placed.groupBy("shard").count().agg(F.max("count")).first()[0], rows_per_file)
    spread = F.pmod(F.xxhash64(*docs.columns), F.lit(pieces))
    placed.withColumn(piece, spread).repartition(shards * pieces, "shard", piece).drop(piece).write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard and next_shards.

    The law is ``key``: the id and the number of shards decide alone, so equal texts with different ids may part. ``grown_shard`` is the shard with one more: the
    same, or the new one. ``size`` is the text's bytes in UTF-8 plus 16; a null text has none, and the checksum 0. Null ids share a
    shard, as do equal ids, but their rows are dealt to tasks by all they hold. Rows equal in id, size and checksum are counted before they
    are placed and take neighbouring slots. An empty table gives none.
    """
    text = F.col(text_col).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16).alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"))
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    counted = stage(with_shard(counted, shards, "doc_id", seed), "sharded-ids")
    placed = with_slot(counted, rows.columns, copies="copies", seed=seed)
    # Copies are written out in pieces that are dealt anew, so that one row with very many is no single task's work.
    piece = F.explode(F.sequence(_long(0), F.floor((F.col("copies") - 1) / COPIES_AT_ONCE)))
    pieces = placed.withColumn("piece", piece).hint("rebalance")
    first = F.col("piece") * COPIES_AT_ONCE
    number = F.explode(F.sequence(first, F.least(first + COPIES_AT_ONCE, F.col("copies")) - 1))
    return pieces.withColumn("number", number).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("slot") + F.col("number")).alias("slot"),
        F.when(F.col("next_shards") == shards, F.lit(shards)).otherwise(F.col("shard")).alias("grown_shard"), "next_shards")


ORACLE = f"""
    with recursive source as (
      select doc_id, coalesce(text, '') as text, octet_length(encode(coalesce(text, ''))) + 16 as size,
        coalesce(cast('0x' || substr(md5('{SEED}:' || doc_id::varchar), 1, 13) as bigint), 0) as key from documents),
    jumps as (
      select distinct key, key::hugeint as state, -1::bigint as b, 0::bigint as j from source
      union all
      select key, next, j, cast(floor((j + 1)::double * (2147483648.0::double / (next // 8589934592 + 1)::double)) as bigint)
      from (select key, j, (state * {MULTIPLIER} + 1) % 18446744073709551616 as next from jumps where j < 40)),
    found as (select key, b as shard, j as next_shards from jumps where j >= 40),
    crc_table as (
      select list(crc order by i) as t from (
        select i, list_reduce(range(8), lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as crc from range(256) as r(i))),
    bytes as (select text, hex(encode(text)) as hex from (select distinct text from source)),
    sums as (
      select text, xor(4294967295::bigint, list_reduce([('0x' || substr(hex, 2 * i + 1, 2))::bigint for i in range(length(hex) // 2)],
        lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295::bigint)) as text_crc32
      from bytes, crc_table)
    select doc_id, size, text_crc32, 'key' as law, cast(shard as integer) as shard,
      row_number() over (partition by shard order by cast('0x' || substr(md5('{SEED}:' || coalesce(doc_id::varchar, 'null')
        || '|' || size || '|' || text_crc32), 1, 13) as bigint), doc_id) - 1 as slot,
      cast(case when next_shards = 40 then 40 else shard end as integer) as grown_shard, next_shards
    from source join found using (key) join sums using (text)"""
