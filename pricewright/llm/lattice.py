"""Score texts by the likelihood of all their segmentations into subwords.

The pieces are those of an existing vocabulary file; how likely each is, is
counted on the training documents. Words are scored once each, in a table that
is joined to the documents.
"""

from collections import Counter
from collections.abc import Iterator
from math import exp, log, log1p, log10

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F

from .base import ship_package, stage

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SMOOTHING = 0.1
#: Words of the broadcast head, their longest, and how many words one task counts before it hands them on.
HEAD_WORDS, HEAD_BYTES, COUNTED = 200_000, 64, 400_000
START = "▁"
LN10 = log(10)


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (held_out, text): each word with its count in training texts and in all."""

    def rows(train: Counter, held: Counter) -> pa.RecordBatch:
        words = list(train.keys() | held.keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), pa.array([train[w] for w in words], pa.int64()), pa.array([train[w] + held[w] for w in words], pa.int64())],
            names=["word", "count", "seen"])

    train, held = Counter(), Counter()
    for batch in batches:
        for is_held, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            (held if is_held else train).update((text.as_py() or b"").lower().split())
            if len(train) + len(held) > COUNTED:
                yield rows(train, held)
                train, held = Counter(), Counter()
    yield rows(train, held)


class Pieces:
    """A vocabulary with its log probabilities, and the marginal of a word."""

    def __init__(self, scores: dict[str, float], byte_scores: list[float]):
        self.table: dict[str, float | None] = {}
        for piece in scores:
            for i in range(1, len(piece)):
                self.table.setdefault(piece[:i], None)
        self.table.update(scores)
        self.byte_scores = byte_scores

    def log_marginal(self, word: str) -> float:
        """Natural log of the summed probability of all segmentations.

        A character that is no piece is spelled in bytes.
        """
        text, get = START + word, self.table.get
        size = len(text)
        # forward[i]: log probability of all ways to write the first i characters.
        forward: list[float | None] = [None] * (size + 1)
        forward[0] = 0.0
        for i in range(size):
            here, stop = forward[i], i + 1
            score = get(text[i], False)
            if not score:
                score = sum([self.byte_scores[b] for b in text[i].encode("utf-8", "surrogatepass")])
            while True:
                if score is not None:
                    new, old = here + score, forward[stop]
                    if old is None:
                        forward[stop] = new
                    elif new > old:
                        forward[stop] = new + log1p(exp(old - new))
                    else:
                        forward[stop] = old + log1p(exp(new - old))
                if stop == size:
                    break
                stop += 1
                score = get(text[i:stop], False)
                if score is False:
                    break
        return forward[size]


def _piece_counter(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        counts = [0] * encoder.get_piece_size()
        for batch in batches:
            words = [w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
            for ids, n in zip(encoder.encode(words, num_threads=1), batch.column(1).to_pylist()):
                for i in ids:
                    counts[i] += n
        found = [i for i, n in enumerate(counts) if n]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array([counts[i] for i in found], pa.int64())], names=["piece", "n"])
    return run


def learn_pieces(spark: SparkSession, words: DataFrame, texts: int, vocabulary: str) -> tuple[Pieces, float]:
    """The scores of the vocabulary's pieces on training words, and the log probability of an end."""
    with open(vocabulary, "rb") as file:
        model = file.read()
    encoder = sentencepiece.SentencePieceProcessor(model_proto=model)
    counted = words.where("count > 0").select("word", "count").mapInArrow(_piece_counter(model), "piece int, n long")
    # One row per piece of the vocabulary at most.
    counts = {r.piece: r.n for r in counted.groupBy("piece").agg(F.sum("n").alias("n")).collect()}
    ids = [i for i in range(encoder.get_piece_size()) if not (encoder.is_control(i) or encoder.is_unknown(i))]
    total = log(sum(counts.get(i, 0) for i in ids) + texts + SMOOTHING * (len(ids) + 1))
    scores = {i: log(counts.get(i, 0) + SMOOTHING) - total for i in ids}
    byte_scores = [0.0] * 256
    for i in ids:
        if encoder.is_byte(i):
            byte_scores[int(encoder.id_to_piece(i)[3:-1], 16)] = scores[i]
    pieces = {encoder.id_to_piece(i): s for i, s in scores.items() if not encoder.is_byte(i)}
    return Pieces(pieces, byte_scores), log(texts + SMOOTHING) - total


def _scored_words(pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marginal = pieces.value.log_marginal
        for batch in batches:
            words, counts, seen = batch.columns
            out = [marginal(w.decode("utf-8", "surrogatepass")) / LN10 for w in words.to_pylist()]
            yield pa.RecordBatch.from_arrays([words, counts, seen, pa.array(out, pa.float64())], names=["word", "count", "seen", "log10"])
    return run


DOC_SCHEMA = "row long, doc_id {id}, held_out boolean, n_tokens long, n_known long, base double, score double, rest array<struct<word:binary,n:long>>"


def _head_scores(head):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = head.value
        for batch in batches:
            out, rest, times, ends = [], [], [], [0]
            for text in batch.column("text"):
                words = (text.as_py() or b"").lower().split()
                n_known, base, score = 0, 0.0, 0.0
                for word, n in Counter(words).items():
                    facts = known.get(word)
                    if facts is None:
                        rest.append(word)
                        times.append(n)
                    else:
                        n_known += n if facts[0] else 0
                        base += n * facts[1]
                        score += n * facts[2]
                out.append((len(words), n_known, base, score))
                ends.append(len(rest))
            columns = list(zip(*out)) if out else [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            pairs = pa.StructArray.from_arrays([pa.array(rest, pa.binary()), pa.array(times, pa.int64())], ["word", "n"])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *(pa.array(c, k) for c, k in zip(columns, kinds)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)],
                names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rest"])
    return run


def frequent_words(lexicon: DataFrame) -> dict[bytes, tuple[bool, float, float]]:
    """The most frequent short words with what is known of them: no more than ``HEAD_WORDS`` of them.

    They are those seen at least so often, the least such number of a fixed scale that keeps the bound;
    a histogram of that scale, some hundred rows, tells which.
    """
    step = F.floor(F.log2("seen") * 16).alias("step")
    short = lexicon.where(F.octet_length("word") <= HEAD_BYTES)
    steps = sorted(((r.step, r["n"]) for r in short.groupBy(step).agg(F.count("*").alias("n")).collect()), reverse=True)
    total, least = 0, None
    for at, n in steps:
        total += n
        if total > HEAD_WORDS:
            break
        least = at
    if least is None:
        return {}
    top = short.where(F.floor(F.log2("seen") * 16) >= least).select("word", "count", "log10")
    return {bytes(r.word): (r["count"] > 0, log10(r["count"] + SMOOTHING), r.log10) for r in top.toLocalIterator()}


def score_texts(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text", held_out_of: int = 10) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Tokens are lower-cased words and one end. Documents whose CRC-32 of the id as text is no multiple
    of ``held_out_of`` are learnt from; a null id counts as one of them. ``base_score`` is the smoothed
    word unigram's log10 probability. ``score`` is the subword model's: the sum over words
    of the log10 marginal over every way to cut the word into pieces, and the end's. Null
    texts are empty. With no training document N and V are 0.

    Every word is counted, and scored once. The ``HEAD_WORDS`` most frequent words of up to
    ``HEAD_BYTES`` bytes are looked up in a broadcast table, which these two numbers bound; all others
    are joined by word. The sums are the same either way.
    """
    spark = docs.sparkSession
    ship_package(spark)
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % held_out_of == 0, F.lit(False))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text_col).cast("binary").alias("text"))

    counted = rows.select("held_out", "text").mapInArrow(word_counts, "word binary, count long, seen long")
    words = stage(counted.groupBy("word").agg(F.sum("count").alias("count"), F.sum("seen").alias("seen")), "word-counts")
    texts = rows.where(~F.col("held_out")).count()
    facts = words.agg(F.sum("count"), F.sum(F.when(F.col("count") > 0, 1))).first()
    train_tokens, distinct = (facts[0] or 0) + texts, (facts[1] or 0) + (texts > 0)
    whole = log10(train_tokens + SMOOTHING * (distinct + 1))

    pieces, end = learn_pieces(spark, words, texts, vocabulary)
    shared = spark.sparkContext.broadcast(pieces)
    lexicon = stage(words.mapInArrow(_scored_words(shared), "word binary, count long, seen long, log10 double"), "lexicon")
    head = spark.sparkContext.broadcast(frequent_words(lexicon))

    schema = DOC_SCHEMA.format(id=rows.schema["doc_id"].dataType.simpleString())
    parts = stage(rows.mapInArrow(_head_scores(head), schema), "head-scores")
    rest = parts.select("row", F.inline("rest")).join(lexicon.select("word", "count", "log10"), "word")
    rest = rest.groupBy("row").agg(
        F.sum(F.when(F.col("count") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10(F.col("count") + F.lit(SMOOTHING))).alias("more_base"),
        F.sum(F.col("n") * F.col("log10")).alias("more_score"),
    )
    ends = F.lit(log10(texts + SMOOTHING))
    return (
        parts.drop("rest").join(rest, "row", "left")
        .select(
            "doc_id", "held_out", (F.col("n_tokens") + 1).alias("n_tokens"),
            (F.col("n_known") + F.coalesce("more_known", F.lit(0)) + int(texts > 0)).cast("long").alias("n_known"),
            F.lit(train_tokens).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("more_base", F.lit(0.0)) + ends - (F.col("n_tokens") + 1) * F.lit(whole)).alias("base_score"),
            (F.col("score") + F.coalesce("more_score", F.lit(0.0)) + F.lit(end / LN10)).alias("score"),
        )
    )
