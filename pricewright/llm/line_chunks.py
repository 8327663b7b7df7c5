"""Remove runs of lines that the corpus holds already, in DataFrame functions only."""

from pyspark.sql import Column, DataFrame, functions as F

from pricewright.operators.barrier import with_once

from .base import stage
from .phrase_index import _small

#: One line in so many ends a chunk; the rolling hash sees a line and the one before it.
DIVISOR = 3
STEP = 31
LEAST_LINES = 2
KEY = ["_doc", "_key"]


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def with_chunks(rows: DataFrame, text: str, divisor: int) -> DataFrame:
    """Add ``_lines`` and ``_chunks``, each chunk with its number, first and last line.

    A chunk ends behind every line at which the rolling hash of the line hashes is a multiple
    of ``divisor``, and at the end of the text. So where chunks end depends on two lines, not
    on how much stands before them. A null text has no chunk.
    """
    rows = with_once(rows, _lines=F.split(F.col(text), "\n", -1))
    rows = with_once(rows, _hashes=F.transform("_lines", _line_hash))
    before = F.concat(F.array(F.lit(0).cast("long")), F.col("_hashes"))
    rows = with_once(rows, _rolled=F.zip_with("_hashes", F.slice(before, 1, F.size("_hashes")), lambda h, b: h + b * STEP))
    last = F.size("_rolled") - 1
    is_end = F.transform("_rolled", lambda r, i: F.struct(i.alias("line"), ((r % divisor == 0) | (i == last)).alias("end")))
    rows = with_once(rows, _ends=F.transform(F.filter(is_end, lambda x: x["end"]), lambda x: x["line"]))
    starts = F.concat(F.array(F.lit(0)), F.transform("_ends", lambda e: e + 1))
    rows = with_once(rows, _chunks=F.transform(
        F.arrays_zip(F.col("_ends").alias("b"), F.slice(starts, 1, F.size("_ends")).alias("a")), lambda c, i: F.struct(i.alias("idx"), c["a"].alias("a"), c["b"].alias("b"))))
    return rows.drop("_hashes", "_rolled", "_ends")


def _text_of(chunk: Column) -> Column:
    return F.array_join(F.slice("_lines", chunk["a"] + 1, chunk["b"] - chunk["a"] + 1), "\n")


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR) -> DataFrame:
    """Rows (_doc, _key, idx) of the chunks to remove: two lines or more, not all blank, and standing earlier too.

    Earlier is a smaller id (null last), then a smaller hash of the text, then a smaller chunk number.
    Rows equal in id and text are not earlier than each other. Hashes only propose; the
    bytes of a chunk are compared with those of the first one before it goes.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("_doc"), F.xxhash64(text).alias("_key"), text.alias("_text"))
    long_enough = F.filter("_chunks", lambda c: c["b"] - c["a"] + 1 >= LEAST_LINES)
    chunks = with_chunks(rows, "_text", divisor).select(*KEY, "_lines", F.explode(long_enough).alias("c"))
    chunks = with_once(chunks, chunk=_text_of(F.col("c"))).where(F.trim(F.regexp_replace("chunk", "\\s+", " ")) != "")
    filed = stage(chunks.select(*KEY, F.col("c.idx").alias("idx"), F.xxhash64("chunk").alias("hash"), F.octet_length("chunk").alias("octets")), "chunks")

    place = F.struct(F.col("_doc").isNull().alias("none"), *KEY, "idx")
    firsts = filed.groupBy("hash", "octets").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    firsts = stage(firsts, "first-chunks")
    met = filed.join(firsts, ["hash", "octets"])
    is_first = F.col("first.none").eqNullSafe(F.col("_doc").isNull()) & F.col("first._doc").eqNullSafe(F.col("_doc")) & (F.col("first._key") == F.col("_key")) & (F.col("first.idx") == F.col("idx"))
    asked = met.select(*KEY, F.struct("idx", "hash", "octets", is_first.alias("first")).alias("ask")).distinct()
    asked = _small(stage(asked.groupBy(*KEY).agg(F.collect_list("ask").alias("_asked")), "asked-chunks"), F.size("_asked") * 24 + 16)

    again = rows.join(asked, [rows[c].eqNullSafe(asked[c]) for c in KEY]).select(rows["_doc"], rows["_key"], "_text", "_asked").dropDuplicates(KEY)
    again = with_chunks(again, "_text", divisor).select(*KEY, "_lines", "_chunks", F.explode("_asked").alias("ask"))
    texts = again.select(*KEY, "ask.*", _text_of(F.element_at("_chunks", F.col("ask.idx") + 1)).alias("chunk"))
    texts = stage(texts, "chunk-texts")
    first = texts.where("first").select("hash", "octets", F.col("chunk").alias("same"))
    return texts.where("not first").join(first, ["hash", "octets"]).where("chunk = same").select(*KEY, "idx")


def remove_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR,
                           counts: bool = False) -> DataFrame:
    """``docs`` with repeated chunks taken out of ``text_col``; with ``counts`` also n_lines and n_removed.

    Texts without a repeated chunk stay as they are to the byte; null stays null (0 lines).
    What is left of the others is joined by newlines; a text of which nothing is left is empty.
    """
    gone = repeated_chunks(docs, id_col, text_col, divisor).groupBy(*KEY).agg(F.collect_set("idx").alias("_gone"))
    gone = _small(stage(gone, "removed-chunks"), F.size("_gone") * 8 + 16)
    text = F.col(text_col).cast("string")
    # Own names for all columns: those of the documents may clash with the ones used here.
    own = {c: f"_own{i}" for i, c in enumerate(docs.columns)}
    keyed = docs.select(*[F.col(c).alias(name) for c, name in own.items()], F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_hash"))
    rows = keyed.join(gone, keyed["_id"].eqNullSafe(gone["_doc"]) & (keyed["_hash"] == gone["_key"]), "left").select(*own.values(), "_text", "_gone")

    touched = with_chunks(rows.where("_gone is not null"), "_text", divisor)
    left = F.filter("_chunks", lambda c: ~F.array_contains(F.col("_gone"), c["idx"]))
    touched = with_once(touched, _kept=F.flatten(F.transform(left, lambda c: F.slice("_lines", c["a"] + 1, c["b"] - c["a"] + 1))))
    n_lines = F.coalesce(F.regexp_count("_text", F.lit("\n")) + 1, F.lit(0))
    n_removed = F.size("_lines") - F.size("_kept")
    whole = rows.where("_gone is null").select(
        *[F.col(name).alias(c) for c, name in own.items()],
        *([n_lines.cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed")] if counts else []))
    cut = touched.select(
        *[(F.array_join("_kept", "\n") if c == text_col else F.col(name)).alias(c) for c, name in own.items()],
        *([F.size("_lines").cast("long").alias("n_lines"), n_removed.cast("long").alias("n_removed")] if counts else []))
    return whole.union(cut)


def _pair_text(i: Column) -> Column:
    return F.concat_ws("\n", F.get("_lines", i), F.get("_lines", i + 1))


def _pairs(rows: DataFrame, made: Column, at: Column) -> DataFrame:
    """Add ``made``, computed once per row from its ``_lines``, exploded to ``at``; long texts are not copied along."""
    return with_once(rows, _made=made).select(*KEY, F.explode("_made").alias("_one")).select(*KEY, at)


def repeated_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (_doc, _key, idx) of the lines that, with the line behind, are not all blank and stand earlier too.

    Earlier is meant as in ``repeated_chunks``, with the number of the line as the last of the order. Bytes are compared with those of the first pair.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("_doc"), F.xxhash64(text).alias("_key"), text.alias("_text")).where("_text is not null")
    lined = with_once(rows, _lines=F.split(F.col("_text"), "\n", -1)).where(F.size("_lines") >= LEAST_LINES).drop("_text")
    lined = with_once(lined, _blank=F.transform("_lines", lambda x: F.trim(F.regexp_replace(x, "\\s+", " ")) == ""))
    told = F.filter(F.sequence(F.lit(0), F.size("_lines") - 2), lambda i: ~(F.get("_blank", i) & F.get("_blank", i + 1)))
    told = F.transform(told, lambda i: F.struct(i.alias("idx"), F.xxhash64(_pair_text(i)).alias("hash"), F.octet_length(_pair_text(i)).alias("octets")))
    filed = stage(_pairs(lined, told, F.col("_one.*")), "line-pairs")

    place = F.struct(F.col("_doc").isNull().alias("none"), *KEY, "idx")
    firsts = filed.groupBy("hash", "octets").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last").drop("last")
    met = filed.join(stage(firsts, "first-pairs"), ["hash", "octets"])
    asked = met.select(*KEY, F.struct("idx", "hash", "octets", (place == F.col("first")).alias("first")).alias("ask")).distinct()
    asked = _small(stage(asked.groupBy(*KEY).agg(F.collect_list("ask").alias("_asked")), "asked-pairs"), F.size("_asked") * 24 + 16)

    again = rows.join(asked, [rows[c].eqNullSafe(asked[c]) for c in KEY]).select(rows["_doc"], rows["_key"], "_text", "_asked").dropDuplicates(KEY)
    again = with_once(again, _lines=F.split(F.col("_text"), "\n", -1)).drop("_text")
    answers = F.transform("_asked", lambda x: F.struct(x["idx"].alias("idx"), x["hash"].alias("hash"), x["octets"].alias("octets"), x["first"].alias("first"), _pair_text(x["idx"]).alias("pair")))
    texts = stage(_pairs(again, answers, F.col("_one.*")), "pair-texts")
    first = texts.where("first").select("hash", "octets", F.col("pair").alias("same"))
    return texts.where("not first").join(first, ["hash", "octets"]).where("pair = same").select(*KEY, "idx")


def remove_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without every run of two or more lines, not all blank, that stands earlier.

    Chunks end where two lines say so, and what a repeated passage has in shorter chunks or at its edges stays. Here all pairs of neighbouring
    lines are compared, so a repeated run goes whole, wherever chunks end; blank lines between two removed ones go along.
    Of every line that goes an earlier one stays. Other texts stay as they are to the byte.
    """
    gone = repeated_pairs(docs, id_col, text_col).groupBy(*KEY).agg(F.collect_set("idx").alias("_gone"))
    gone = _small(stage(gone, "removed-pairs"), F.size("_gone") * 8 + 16)
    text = F.col(text_col).cast("string")
    own = {c: f"_own{i}" for i, c in enumerate(docs.columns)}
    keyed = docs.select(*[F.col(c).alias(name) for c, name in own.items()], F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_hash"))
    rows = keyed.join(gone, keyed["_id"].eqNullSafe(gone["_doc"]) & (keyed["_hash"] == gone["_key"]), "left").select(*own.values(), "_text", "_gone")

    touched = with_once(rows.where("_gone is not null"), _lines=F.split(F.col("_text"), "\n", -1))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.concat("_gone", F.transform("_gone", lambda i: i + 1)))
    touched = with_once(touched, _left=left)
    kept = F.array_join(F.transform("_left", lambda i: F.get("_lines", i)), "\n")
    whole = rows.where("_gone is null").select(*[F.col(name).alias(c) for c, name in own.items()])
    return whole.union(touched.select(*[(kept if c == text_col else F.col(name)).alias(c) for c, name in own.items()]))


def chunk_digests(docs: DataFrame) -> DataFrame:
    """Per row of documents: doc_id, n_lines, n_removed and the SHA-256 of what is left (null: empty)."""
    rows = remove_repeated_chunks(docs.select("doc_id", "text"), counts=True)
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = """
with doc as (select doc_id, text, row_number() over () as r from documents),
line as (
  select r, doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from doc where text is not null
), hashed as (select *, ('0x' || substr(md5(line), 1, 8))::bigint as h from line),
marked as (
  select *, ((h + 31 * coalesce(lag(h) over (partition by r order by i), 0)) % 3 = 0)::int as ends from hashed
), numbered as (
  select *, coalesce(sum(ends) over (partition by r order by i rows between unbounded preceding and 1 preceding), 0) as idx from marked
), chunk as (
  select r, doc_id, idx, count(*) as n, string_agg(line, chr(10) order by i) as chunk from numbered group by all
), gone as (
  select r, idx, row_number() over (partition by chunk order by doc_id nulls last, r, idx) > 1 as gone
  from chunk where n >= 2 and regexp_replace(chunk, '\\s+', '', 'g') <> ''
), kept as (
  select r, count(*) as n_lines, count(*) filter (coalesce(gone, false)) as n_removed,
    string_agg(line, chr(10) order by i) filter (not coalesce(gone, false)) as kept
  from numbered left join gone using (r, idx) group by r
)
select doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from doc left join kept using (r)
"""
