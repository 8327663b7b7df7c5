"""Mix sources to target weights: blocks of tokens, drawn per output shard, joined by index.

All of it is DataFrame functions. Texts are read once, for their lengths; from
there only numbers move.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewright.operators.barrier import with_once

from .base import WORD, pieces_of, stage

#: Multipliers of the affine steps: primes, of which one at least divides no number below 2**43.
PRIMES = (1000003, 999983, 1000033)
DOCS_PER_BUCKET = 256
CHUNK = 1024


def _mixed(value: Column, *salt) -> Column:
    return F.xxhash64(value, *[F.lit(s) if not isinstance(s, Column) else s for s in salt])


def _ones(bits: Column) -> Column:
    return F.expr("1L") * F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1


def permuted(df: DataFrame, index: str, size: str, salt: list, out: str) -> DataFrame:
    """Add ``out``, a pseudorandom permutation of 0..size-1 applied to ``index``.

    Two rounds of an affine map modulo ``size`` and a two-step Feistel network
    on the numbers below the largest power of two in ``size``; each maps
    0..size-1 onto itself, so no index is lost or met twice.
    """
    n, x, half = F.col(size), F.col("_x"), F.col("_half")
    first, second, third = (F.lit(p).cast("long") for p in PRIMES)
    step = F.when(n % first != 0, first).when(n % second != 0, second).otherwise(third)
    bits = F.length(F.bin(n)) - 1
    df = with_once(df, _x=F.col(index), _k=bits, _half=F.floor(bits / 2).cast("int"), _step=step)
    power = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_k"))
    # Each step is computed once per row; nested, they would repeat each other many times over.
    for turn in range(2):
        df = with_once(df, _x=(x * F.col("_step") + F.pmod(_mixed(n, turn, *salt), n)) % n)
        low, high = x.bitwiseAND(_ones(half)), F.call_function("shiftright", x, half)
        df = with_once(df, _low=low, _high=high.bitwiseXOR(_mixed(low, turn, 1, *salt).bitwiseAND(_ones(F.col("_k") - half))))
        low = F.col("_low").bitwiseXOR(_mixed(F.col("_high"), turn, 2, *salt).bitwiseAND(_ones(half)))
        df = with_once(df, _x=F.when(x < power, F.call_function("shiftleft", F.col("_high"), half).bitwiseOR(low)).otherwise(x))
    return df.withColumn(out, x).drop("_x", "_k", "_half", "_step", "_low", "_high")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row per source: ``_src``, ``source_size`` and ``target``.

    Sources in code point order, null last, take the weights in turn. A target
    is the smaller of ``most`` times the source's size and its weight times one
    level, which is what is left when every excess has been shared out again.
    """
    table = sizes.groupBy("_src", "_null", "_source").agg(F.sum("size").alias("source_size"))
    order = Window.partitionBy(F.lit(0)).orderBy("_null", "_source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = table.withColumn("_w", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights)) + 1))
    table = table.withColumn("_cap", F.col("source_size") * float(most))
    everything = Window.partitionBy(F.lit(0))
    filling = everything.orderBy(F.col("_cap") / F.col("_w"), "_null", "_source")
    table = (
        table.withColumn("_want", F.sum("source_size").over(everything) * float(share))
        .withColumn("_capped", F.sum("_cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_open", F.sum("_w").over(filling.rowsBetween(0, Window.unboundedFollowing)))
    )
    level = (F.col("_want") - F.coalesce("_capped", F.lit(0.0))) / F.col("_open")
    # The level to fill to is that of the first source, by cap per weight, which its cap does not stop.
    table = table.withColumn("_level", F.min(F.when(level <= F.col("_cap") / F.col("_w"), F.struct(F.col("_cap") / F.col("_w"), level.alias("level")))).over(everything)["level"])
    reach = F.when(F.col("_level").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_level") * F.col("_w")))
    return table.select("_src", "_null", "_source", "source_size", reach.alias("target"))


def plan_mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
             block: int = 128, shard_slots: int = 4096, seed: int = 17, id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Plan a mix; returns (documents, pieces, slots), all staged or derived from staged tables.

    Documents of a source, in pseudorandom order, form one stream of words that is
    cut into blocks of ``block`` words (the last may be shorter). A source
    fills as many slots as its target holds mean blocks. Which slots of the output
    these are is drawn without replacement, so a shard's counts are
    multinomial draws given the totals. Its slots, numbered in the order drawn, are mapped through
    the source's permutation of block numbers, and go round again once every block is used.

    ``documents``: id, size, source_size, target and the place in the stream.
    ``pieces``: which words of which document stand in which block.
    ``slots``: shard, slot, source and block.

    Null texts and texts without words have size 0 and are in no block. A null source is a
    source of its own. Null and repeated ids are rows like any other.
    """
    spark = docs.sparkSession
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    source = F.col(source_col).cast("string")
    sizes = stage(docs.select(
        F.col(id_col).alias("_id"), source.alias("_source"), source.isNull().alias("_null"),
        F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source)).alias("_src"),
        words.alias("size"), F.xxhash64(F.col(id_col), F.lit(seed)).alias("_key"),
    ), "mix-sizes")

    # Running sums in two levels: buckets of a source, then documents of a bucket.
    bits = (pieces_of(sizes.count(), DOCS_PER_BUCKET) - 1).bit_length()
    bucket = F.shiftrightunsigned(F.col("_key"), 64 - bits) if bits else F.lit(0).cast("long")
    sizes = sizes.withColumn("_bucket", bucket)
    buckets = sizes.groupBy("_src", "_bucket").agg(F.sum("size").alias("_bucket_size"))
    of_source = Window.partitionBy("_src").orderBy("_bucket")
    buckets = buckets.withColumn("_base", F.sum("_bucket_size").over(of_source) - F.col("_bucket_size"))
    table = targets(sizes, weights, share, most)
    table = table.withColumn("_blocks", F.ceil(F.col("source_size") / block).cast("long"))
    table = table.withColumn("_quota", F.when(F.col("_blocks") == 0, F.lit(0).cast("long")).otherwise(
        F.least(F.round(F.col("target") * F.col("_blocks") / F.col("source_size")), F.col("_blocks") * float(most)).cast("long")))
    quotas = Window.partitionBy(F.lit(0)).orderBy("_null", "_source")
    table = stage(table.withColumn("_first", F.sum("_quota").over(quotas) - F.col("_quota")), "mix-sources")
    total = table.agg(F.sum("_quota")).first()[0] or 0

    here = Window.partitionBy("_src", "_bucket").orderBy("_key", "_id", "size")
    facts = buckets.join(table.select("_src", "source_size", "target"), "_src").drop("_bucket_size")
    documents = stage(
        sizes.withColumn("_row", F.row_number().over(here))
        .withColumn("_before", F.sum("size").over(here.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .join(facts, ["_src", "_bucket"])
        .select("_id", "size", "source_size", "target", "_src", "_source", "_bucket", "_row", (F.col("_base") + F.col("_before")).alias("_start")),
        "mix-documents",
    )
    end = F.col("_start") + F.col("size")
    covered = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("_start") / block), F.floor((end - 1) / block)))
    pieces = documents.withColumn("_block", F.explode_outer(covered)).withColumn(
        "_from", F.greatest(F.col("_block") * block - F.col("_start"), F.lit(0).cast("long")),
    ).withColumn("_words", F.least((F.col("_block") + 1) * block, end) - F.col("_start") - F.col("_from"))

    # Slot t of the output shows unit p of all quotas; units of a source lie side by side.
    slots = spark.range(total).withColumnRenamed("id", "_slot").withColumn("_all", F.lit(max(total, 1)).cast("long"))
    slots = permuted(slots, "_slot", "_all", [seed], "_unit").drop("_all")
    slots = slots.withColumn("_chunk", F.floor(F.col("_unit") / CHUNK))
    last = F.col("_first") + F.col("_quota") - 1
    chunks = table.where("_quota > 0").withColumn("_chunk", F.explode(F.sequence(F.floor(F.col("_first") / CHUNK), F.floor(last / CHUNK))))
    drawn = slots.join(chunks, "_chunk").where((F.col("_unit") >= F.col("_first")) & (F.col("_unit") <= last))
    drawn = drawn.withColumn("_index", (F.col("_unit") - F.col("_first")) % F.col("_blocks"))
    drawn = permuted(drawn, "_index", "_blocks", [F.col("_src"), seed], "_block")
    return documents, pieces, drawn.select(F.floor(F.col("_slot") / shard_slots).alias("shard"), F.col("_slot").alias("slot"), "_src", F.col("_source").alias("source"), "_block")


def mixed_blocks(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: shard, slot, source, block, doc_id, first_word, n_words (see ``plan_mix``)."""
    _, pieces, slots = plan_mix(docs, **options)
    parts = pieces.where("_words > 0").select("_src", "_block", F.col("_id").alias("doc_id"), F.col("_from").alias("first_word"), F.col("_words").alias("n_words"))
    return slots.join(parts, ["_src", "_block"]).select("shard", "slot", "source", F.col("_block").alias("block"), "doc_id", "first_word", "n_words")


def shard_counts(docs: DataFrame, **options) -> DataFrame:
    """How many slots of each source every output shard drew."""
    return plan_mix(docs, **options)[2].groupBy("shard", "source").agg(F.count("*").alias("slots"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target and the words the mix takes of it."""
    _, pieces, slots = plan_mix(docs, **options)
    used = slots.groupBy("_src", "_block").agg(F.count("*").alias("_used"))
    return (
        pieces.join(used, ["_src", "_block"], "left")
        .groupBy("_src", "_bucket", "_row", "_id", "size", "source_size", "target")
        .agg(F.coalesce(F.sum(F.col("_words") * F.col("_used")), F.lit(0)).cast("long").alias("taken"))
        .select(F.col("_id").alias("doc_id"), "size", "source_size", F.col("target").cast("double").alias("target"), "taken")
    )
