"""Benchmark decontamination with a positional inverted index, in DataFrame functions only."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from .base import LOWER, UPPER, stage

#: What stands between words: ASCII that is no letter and no digit.
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Rows and bytes up to which a table of test terms or of document keys is broadcast; larger ones are joined by key.
SMALL_ROWS, SMALL_BYTES = 500_000, 32 << 20
DOC = ["doc", "text_key"]


def _lowered(word: Column) -> Column:
    """A-Z lower-cased; the cheap function where the word is all ASCII."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def _words(rows: DataFrame, text: str) -> DataFrame:
    """One row per word: ``pos`` counts up by one from word to word, from 0 or 1, and ``term``."""
    split = F.split(F.col(text), GAPS)
    each = rows.select(*[c for c in rows.columns if c != text], F.posexplode(split).alias("pos", "term")).where("term != ''")
    return each.withColumn("term", _lowered(F.col("term")))


def _small(df: DataFrame, size: Column) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is within the bound."""
    rows, octets = df.agg(F.count("*"), F.sum(size)).first()
    return F.broadcast(df) if rows <= SMALL_ROWS and (octets or 0) <= SMALL_BYTES else df


def build_index(docs: DataFrame, terms: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store the postings of ``docs``: one row (term, doc, text_key, pos) per word.

    With ``terms`` (column term, distinct) only those that a test can ask for are stored. ``text_key``
    is the XXH64 of the text, which tells rows of one id apart. The index is
    cut by document, as the documents are, so that building it moves nothing.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).cast("string").alias("_text"))
    words = _words(rows, "_text")
    if terms is not None:
        words = words.join(_small(terms, F.octet_length("term") + 16), "term", "left_semi")
    return stage(words.select("term", *DOC, "pos"), "postings")


def test_words(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per word of the items, staged: item (a number of the row), item_id, p (from 0), term and n, the item's words."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("_text"))
    words = _words(rows, "_text")
    of_item = Window.partitionBy("item")
    words = words.withColumn("p", F.col("pos") - F.min("pos").over(of_item)).withColumn("n", F.count("*").over(of_item))
    return stage(words.select("item", "item_id", "p", "term", "n"), "test-words")


def _windows(tests: DataFrame, index: DataFrame, window: int) -> DataFrame:
    """Each test window with its terms as (df, p, term), rarest first; windows with a term that no document has are left out."""
    found = index.groupBy("term").agg(F.count("*").alias("df"))
    known = tests.join(_small(stage(found, "frequencies"), F.octet_length("term") + 16), "term")
    length = F.least(F.lit(window), F.col("n"))
    first = F.greatest(F.col("p") - length + 1, F.lit(0))
    last = F.least(F.col("p"), F.col("n") - length)
    spread = known.withColumn("length", length).withColumn("w", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    grouped = spread.groupBy("item", "w", "length").agg(F.sort_array(F.collect_list(F.struct("df", "p", "term"))).alias("terms"))
    return grouped.where(F.size("terms") == F.col("length"))


def phrase_matches(index: DataFrame, tests: DataFrame, window: int = 10) -> DataFrame:
    """Where runs of test words stand in documents: (doc, text_key, item, item_id, start, stop), whole windows at least.

    For every window the postings of its two rarest terms, moved back by their offsets, are intersected.
    Alignments of a document and an item that survive are intersected with the postings
    of all other terms of the item, and runs as long as a window are kept.
    """
    ranked = _windows(tests, index, window)
    pairs = ranked.select("item", F.col("terms")[0].alias("x"), F.element_at("terms", F.least(F.size("terms"), F.lit(2))).alias("y"))
    pairs = stage(pairs.select(
        "item", F.col("x.term").alias("term"), F.col("x.p").alias("p"), F.col("y.term").alias("term2"), F.col("y.p").alias("p2"),
    ).distinct(), "rare-pairs")
    pairs = _small(pairs, F.octet_length("term") + F.octet_length("term2") + 48)
    key = ["item", "p", "p2", *DOC, "shift"]
    one = index.join(pairs, "term").select("item", "p", "p2", *DOC, (F.col("pos") - F.col("p")).alias("shift"))
    two = index.join(pairs.withColumnRenamed("term", "term1").withColumnRenamed("term2", "term"), "term")
    two = two.select("item", "p", "p2", *DOC, (F.col("pos") - F.col("p2")).alias("shift"))
    # Equal rows of documents give equal postings; a null id is an id like any other.
    same = [one[c].eqNullSafe(two[c]) for c in key]
    alignments = stage(one.join(two, same, "left_semi").select("item", *DOC, "shift").distinct(), "alignments")

    asked = alignments.join(_small(tests, F.octet_length("term") + 40), "item")
    asked = asked.select("item", "item_id", "n", "p", "term", *DOC, "shift", (F.col("shift") + F.col("p")).alias("pos"))
    near = alignments.select(*DOC).distinct()
    near = _small(near, F.lit(24))
    mine = index.join(near, [index[c].eqNullSafe(near[c]) for c in DOC], "left_semi").distinct()
    matched = asked.join(mine, [asked[c].eqNullSafe(mine[c]) for c in ("term", *DOC, "pos")], "left_semi")

    line = Window.partitionBy("item", *DOC, "shift").orderBy("p")
    runs = matched.withColumn("run", F.col("p") - F.row_number().over(line))
    runs = runs.groupBy("item", "item_id", "n", *DOC, "shift", "run").agg(F.min("p").alias("a"), F.max("p").alias("b"))
    runs = runs.where(F.col("b") - F.col("a") + 1 >= F.least(F.lit(window), F.col("n")))
    return runs.select(*DOC, "item", "item_id", (F.col("shift") + F.col("a")).alias("start"), (F.col("shift") + F.col("b") + 1).alias("stop"))


def proximity_matches(index: DataFrame, tests: DataFrame, window: int = 10, within: int = 20) -> DataFrame:
    """Windows all of whose terms stand, in any order, at most ``within`` words from their rarest: (doc, text_key, item, w, at).

    Repeated terms of a window count once.
    """
    ranked = _windows(tests, index, window)
    rare = ranked.select("item", "w", F.col("terms")[0]["term"].alias("term"), F.size(F.array_distinct(F.transform("terms", lambda t: t["term"]))).alias("needed"))
    anchors = index.join(_small(rare, F.octet_length("term") + 32), "term").select("item", "w", "needed", *DOC, F.col("pos").alias("at"))
    terms = ranked.select("item", "w", F.explode(F.array_distinct(F.transform("terms", lambda t: t["term"]))).alias("term"))
    asked = anchors.join(terms, ["item", "w"])
    posted = index.select(*[F.col(c).alias(f"_{c}") for c in index.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("term", *DOC)]
    hits = asked.join(posted, same).where(F.abs(F.col("_pos") - F.col("at")) <= within)
    hits = hits.select(*DOC, "item", "w", "at", "needed", "term")
    full = hits.groupBy(*DOC, "item", "w", "at", "needed").agg(F.count_distinct("term").alias("met"))
    return full.where("met = needed").select(*DOC, "item", "w", "at")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated.

    A null text has no words. Items without words have no windows. Items of equal ids count
    as one; a null item id counts as one item, written as an empty string.
    """
    tests = test_words(items, item_id_col, item_text_col)
    index = build_index(docs, tests.select("term").distinct(), id_col, text_col)
    runs = stage(phrase_matches(index, tests, window), "phrase-matches")

    line = Window.partitionBy(*DOC).orderBy("start", "stop")
    spans = runs.select(*DOC, "start", "stop").distinct()
    reached = F.coalesce(F.max("stop").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = spans.withColumn("new", F.greatest(F.col("stop") - F.greatest("start", reached), F.lit(0)))
    covered = covered.groupBy(*DOC).agg(F.sum("new").alias("n_hit"))
    named = runs.select(*DOC, F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id")).distinct()
    named = named.groupBy(*DOC).agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item_id")), ",").alias("names"))
    hit = covered.join(named, [covered[c].eqNullSafe(named[c]) for c in DOC]).select(covered["doc"], covered["text_key"], "n_hit", "n_items", "names")

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("_key"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long").alias("n_words"))
    joined = rows.join(hit, rows["doc_id"].eqNullSafe(hit["doc"]) & (rows["_key"] == hit["text_key"]), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("names", F.lit("")), 256).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no window of any item."""
    tests = test_words(items)
    index = build_index(docs, tests.select("term").distinct(), id_col, text_col)
    bad = stage(phrase_matches(index, tests, window).select(*DOC).distinct(), "contaminated")
    bad = _small(bad, F.lit(24))
    return docs.join(bad, docs[id_col].eqNullSafe(bad["doc"]) & (F.xxhash64(docs[text_col]) == bad["text_key"]), "left_anti")


#: The same rows, every window of every document compared.
ORACLE = r"""
with doc as (
  select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), item as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), sized as (
  select item_id, w, least(len(w), 10) as n from item where len(w) > 0
), test as (
  select distinct item_id, n, list_slice(w, i, i + n - 1) as win from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i from sized)
), lens as (select distinct n from test),
part as (
  select doc_id, r, n, i, list_slice(w, i, i + n - 1) as win
  from (select doc_id, r, w, n, unnest(range(1, len(w) - n + 2)) as i from doc, lens where len(w) >= n)
), hit as (
  select p.r, p.i, p.n, t.item_id from part p join test t on p.n = t.n and p.win = t.win
), pos as (select r, count(distinct q) as n_hit from (select r, unnest(range(i, i + n)) as q from hit) group by r),
named as (select r, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as names from hit group by r)
select doc.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join pos on pos.r = doc.r left join named on named.r = doc.r
"""
