"""Quality and toxicity of documents by hierarchical empirical Bayes.

A document's own evidence is a log-likelihood ratio. What it starts from is the posterior
rate of its path, shrunk toward its host, which is shrunk toward all hosts.
"""

from collections import Counter
from collections.abc import Iterator
from math import log
from operator import eq

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .base import fresh, ship_package, stage
from .phrase_index import _small

#: Labelled rows a fit uses at most, and features a model holds at most.
LABELLED_ROWS, MODEL_FEATURES = 40_000, 50_000
#: A feature weighs what is left of its log ratio less so many standard errors, if that is at least so much.
MARGIN, LEAST_WEIGHT = 2.0, 1.9
#: Of the labelled texts one in so many says how far scores can be trusted, and teaches no weights.
CALIBRATING = 4
#: Fewer bad or other texts of a length than that say too little by themselves.
FEW = 10
#: Upper bounds of the score's bins, the first for texts without any weighty feature, and of a text's number of features.
SCORES, SIZES = (0.0, 3.0, 6.0), (64, 512)
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
PREFIX = 5
BINS = 10


def features(text: bytes) -> set[bytes]:
    """Words, long words' beginnings, runs of marks at word ends, and binned shares of a text's words."""
    words = text.split()
    if not words:
        return {b"empty"}
    distinct = set(words)
    lowered = {w.lower() for w in distinct}
    found = {b"w:" + w for w in lowered}
    found.update(b"p:" + w[:PREFIX] for w in lowered if len(w) > PREFIX)
    found.update(b"m:" + w[-3:] for w in distinct if w[-1:] in MARKS and w[-2:-1] in MARKS and len(w) > 1)
    n = len(words)
    shares = {
        b"again": sum(map(eq, words, words[1:])) / n,
        b"upper": sum(map(bytes.isupper, words)) / n,
        b"bare": sum(1 for w in words if not w.strip(MARKS)) / n,
        b"marked": sum(1 for w in words if w[-2:].strip(MARKS) == b"" and len(w) > 1) / n,
    }
    found.update(b"s:%b:%d" % (name, min(BINS - 1, int(share * BINS))) for name, share in shares.items())
    return found


def _resemblance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest hash of a text's word 5-grams, which copies with few changes mostly share."""
    for batch in batches:
        found = []
        for text in batch.column(1):
            words = (text.as_py() or b"").lower().split()
            grams = {b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))}
            found.append(min(map(xxhash.xxh64_intdigest, grams)) >> 1)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(found, pa.int64())], names=["doc_id", "low", "toxic", "like"])


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = {}
    for batch in batches:
        for text, *labels in zip(batch.column(0), *(c.to_pylist() for c in batch.columns[1:])):
            at = tuple(labels)
            counts.setdefault(at, Counter()).update(features(text.as_py() or b""))
    table = {}
    for (low, toxic), found in counts.items():
        for feature, n in found.items():
            row = table.setdefault(feature, [0, 0, 0])
            row[0] += n
            row[1] += n * low
            row[2] += n * toxic
    yield pa.RecordBatch.from_arrays(
        [pa.array(table.keys(), pa.binary()), *(pa.array([r[i] for r in table.values()], pa.int64()) for i in range(3))],
        names=["feature", "n", "n_low", "n_toxic"])


def _sure_ratio(hits: Column, n: Column, all_hits: int, all_rows: int) -> Column:
    inside, outside = hits + 0.5, n - hits + 0.5
    ratio = F.log(inside / (all_hits + 1)) - F.log(outside / (all_rows - all_hits + 1))
    return ratio - MARGIN * F.sqrt(1 / inside + 1 / outside)


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> dict:
    """Weights by feature for low quality and toxicity, from at most about ``rows`` labelled documents.

    The sample is drawn by hash of the id; of copies and near copies with the same labels in it one teaches. Labels of one id are combined by maximum of toxic and minimum of quality;
    rows with a null id or label do not teach. The model is bounded by ``MODEL_FEATURES``.

    Features only accuse. What it says for a text that it has none of them, or few for its length, the
    texts tell that taught no weights: by bin of score and length the sure log ratio of their shares among bad and other texts.
    """
    ship_package(docs.sparkSession)
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic")).na.drop()
    known = known.groupBy("doc_id").agg((1 - F.min("quality")).alias("low"), F.max("toxic").alias("toxic"))
    total = known.count()
    share = min(1.0, rows / max(total, 1))
    drawn = known.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    drawn = F.broadcast(drawn) if share * total <= 2 * LABELLED_ROWS else drawn
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    # Copies would pass the words of one text off as typical, so one of those alike teaches.
    alike = texts.join(drawn, "doc_id").mapInArrow(_resemblance, "doc_id long, low int, toxic int, like long")
    one_each = stage(alike.groupBy("like", "low", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "low", "toxic"), "taught")
    labelled = texts.join(F.broadcast(one_each) if share * total <= 2 * LABELLED_ROWS else one_each, "doc_id")
    calibrating = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(CALIBRATING)) == 0
    taught = labelled.where(~calibrating)
    counted = taught.select("text", "low", "toxic").mapInArrow(_count_features, "feature binary, n long, n_low long, n_toxic long")
    counted = stage(counted.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("n", "n_low", "n_toxic")]), "feature-counts")
    # Every text has one share of each kind, so their counts sum to the rows taught.
    of_all = F.col("feature").startswith(F.lit(b"s:again:")) | (F.col("feature") == F.lit(b"empty"))
    n, low, toxic = (x or 0 for x in counted.where(of_all).agg(F.sum("n"), F.sum("n_low"), F.sum("n_toxic")).first())
    model = {"rows": n, "prior": [log((x + 0.5) / (n - x + 0.5)) for x in (low, toxic)], "weights": {}}
    weights = []
    for hits, rows_hit in (("n_low", low), ("n_toxic", toxic)):
        weight = _sure_ratio(F.col(hits), F.col("n"), rows_hit, n)
        weights.append(F.when(weight >= LEAST_WEIGHT, weight).otherwise(0.0))
    scored = counted.select("feature", weights[0].alias("low"), weights[1].alias("toxic")).where("low > 0 or toxic > 0")
    best = scored.orderBy(F.greatest("low", "toxic").desc(), "feature").limit(MODEL_FEATURES)
    model["weights"] = {bytes(r.feature): (r.low, r.toxic) for r in best.collect()}
    shared = docs.sparkSession.sparkContext.broadcast(model)
    told = labelled.where(calibrating).select("low", "toxic", F.col("text").alias("_text"))
    told = stage(told.mapInArrow(_evidence(shared), "low int, toxic int, low_score double, toxic_score double, size long"), "calibration")
    model["cells"] = {kind: _cells(told, kind) for kind in ("low", "toxic")}
    return model


def _bin(value: Column, bounds: tuple) -> Column:
    return sum((F.when(value > bound, 1).otherwise(0) for bound in bounds), F.lit(0))


def _cells(told: DataFrame, kind: str) -> dict[tuple[int, int], float]:
    """Of each bin of length and score, if surely below 0, the log ratio of bad to other texts in it among those of its length.

    Lengths with few bad or few other texts take the ratios of all lengths.
    """
    bins = told.groupBy(_bin(F.col("size"), SIZES).alias("size"), _bin(F.col(f"{kind}_score"), SCORES).alias("score"))
    counts = {(r["size"], r.score): (r.bad, r.n - r.bad) for r in bins.agg(F.sum(kind).alias("bad"), F.count("*").alias("n")).collect()}
    out = {}
    for size in range(len(SIZES) + 1):
        own = {cell: n for cell, n in counts.items() if cell[0] == size}
        pool = own if min((sum(n[i] for n in own.values()) for i in (0, 1)), default=0) >= FEW else counts
        all_bad, all_other = (sum(n[i] for n in pool.values()) for i in (0, 1))
        for score in range(len(SCORES) + 1):
            bad, other = (sum(n[i] for (_, s), n in pool.items() if s == score) for i in (0, 1))
            ratio = log((bad + 0.5) / (all_bad + 1)) - log((other + 0.5) / (all_other + 1))
            sure = ratio + MARGIN * (1 / (bad + 0.5) + 1 / (other + 0.5)) ** 0.5
            if sure < 0:
                out[size, score] = sure
    return out


def _weighed(model: dict, kind: str) -> Column:
    """A text's evidence: its score, unless texts of its length with such a score are surely seldom bad; then how seldom."""
    score, out = F.col(f"{kind}_score"), F.col(f"{kind}_score")
    for (size, bin_), ratio in sorted(model.get("cells", {}).get(kind, {}).items()):
        out = F.when((_bin(F.col("size"), SIZES) == size) & (_bin(score, SCORES) == bin_), F.lit(ratio)).otherwise(out)
    return out.alias(f"{kind}_evidence")


def _evidence(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.value["weights"]
        for batch in batches:
            low, toxic, sizes = [], [], []
            for text in batch.column("_text"):
                a = b = 0.0
                found = features(text.as_py() or b"")
                for feature in found & weights.keys():
                    x, y = weights[feature]
                    a += x
                    b += y
                low.append(a)
                toxic.append(b)
                sizes.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(low, pa.float64()), pa.array(toxic, pa.float64()), pa.array(sizes, pa.int64())],
                names=[*batch.schema.names[:-1], "low_score", "toxic_score", "size"])
    return run


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _concentration(groups: DataFrame, rate: Column, around: Column, prefix: str) -> Column:
    """Moment estimate of how many documents a group's prior is worth, as an aggregate over groups."""
    spread = F.sum(F.col("n") * (rate - around) ** 2) - F.sum(around * (1 - around))
    between = spread / F.sum("n")
    within = F.sum(F.col("n") * around * (1 - around)) / F.sum("n")
    return F.when(between > 0, F.least(F.greatest(within / between - 1, F.lit(1.0)), F.lit(1e6))).otherwise(F.lit(1e6)).alias(prefix)


def site_rates(scored: DataFrame, prior: list[float]) -> DataFrame:
    """Per host and path: documents and the posterior rates of low quality and toxicity.

    ``scored`` has _host, _path, low_evidence and toxic_evidence. A host's expected counts are
    sums over all its documents; its rate is shrunk toward the rate of all documents by a prior worth as many documents as
    the spread between hosts says, and a path's likewise toward its host.
    """
    kinds = ("low", "toxic")
    chance = [_sigmoid(F.col(f"{k}_evidence") + p) for k, p in zip(kinds, prior)]
    paths = stage(scored.groupBy("_host", "_path").agg(F.count("*").alias("n"), *[F.sum(c).alias(k) for c, k in zip(chance, kinds)]), "paths")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), *[F.sum(k).alias(k) for k in kinds])
    total = hosts.agg(F.sum("n").alias("n"), *[F.sum(k).alias(k) for k in kinds]).first()
    n = max(total.n or 0, 1)
    # Kept off 0 and 1, where no evidence would count.
    means = [min(max((total[k] or 0.0) / n, 0.5 / (n + 1)), (n + 0.5) / (n + 1)) for k in kinds]
    worth = hosts.agg(*[_concentration(hosts, F.col(k) / F.col("n"), F.lit(m), k) for k, m in zip(kinds, means)]).first()
    posterior = [((F.col(k) + F.lit((worth[k] or 1e6) * m)) / (F.col("n") + F.lit(worth[k] or 1e6))).alias(f"host_{k}") for k, m in zip(kinds, means)]
    hosts = stage(hosts.select("_host", *posterior), "hosts")
    h = hosts.withColumnRenamed("_host", "_h")
    joined = stage(paths.join(_small(h, F.octet_length("_h") + 24), F.col("_host").eqNullSafe(F.col("_h"))).drop("_h"), "path-rates")
    worth = joined.agg(*[_concentration(joined, F.col(k) / F.col("n"), F.col(f"host_{k}"), k) for k in kinds]).first()
    rates = [((F.col(k) + F.lit(worth[k] or 1e6) * F.col(f"host_{k}")) / (F.col("n") + F.lit(worth[k] or 1e6))).alias(f"{k}_rate") for k in kinds]
    return joined.select("_host", "_path", F.col("n").alias("path_docs"), *rates)


def judge(docs: DataFrame, labels: DataFrame, keep: list[str], host: Column | None = None, path: Column | None = None,
          threshold: float = 0.5, labelled_rows: int = LABELLED_ROWS) -> DataFrame:
    """Per row of ``docs``: the columns ``keep``, p_low, p_toxic and rejected.

    The host is the document's source and the path its source and language, unless given. Null hosts and paths are
    groups of their own. Null and empty texts have one feature, that they are empty. Without
    labels nothing is rejected. A document is rejected if either probability exceeds ``threshold``.
    """
    spark = docs.sparkSession
    model = fit(docs, labels, labelled_rows)
    shared = spark.sparkContext.broadcast(model)
    host = F.col("source").cast("string") if host is None else host
    path = F.col("lang").cast("string") if path is None else path
    rows = docs.select(*keep, host.alias("_host"), path.alias("_path"), F.col("text").cast("binary").alias("_text"))
    own = rows.drop("_text").columns
    renamed = rows.select(*[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(own)], "_text")
    schema = renamed.drop("_text").schema.add("low_score", "double").add("toxic_score", "double").add("size", "long")
    scored = renamed.mapInArrow(_evidence(shared), schema)
    evidence = [_weighed(model, kind) for kind in ("low", "toxic")]
    scored = stage(scored.select(*[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(own)], *evidence), "evidence")
    rates = site_rates(scored, model["prior"])
    rates = _small(stage(rates.withColumnRenamed("_host", "_h").withColumnRenamed("_path", "_p"), "site-rates"), F.octet_length("_h") + F.octet_length("_p") + 40)
    joined = scored.join(rates, F.col("_host").eqNullSafe(F.col("_h")) & F.col("_path").eqNullSafe(F.col("_p")))
    chances = [_sigmoid(F.col(f"{k}_evidence") + _logit(F.col(f"{k}_rate"))).alias(f"p_{k}") for k in ("low", "toxic")]
    out = joined.select(*keep, *chances)
    return out.withColumn("rejected", (F.col("p_low") > threshold) | (F.col("p_toxic") > threshold) if model["rows"] else F.lit(False))


def site_quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per row of documents: doc_id, p_low, p_toxic and rejected."""
    return judge(docs, labels, ["doc_id"], **options)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not rejected."""
    (key,) = fresh(docs, "text_key")
    judged = judge(docs.withColumn(key, F.xxhash64("text")), labels, ["doc_id", key], **options)
    # Rows equal in id and text are judged alike if they share a site; one rejected copy takes only its like along.
    bad = _small(stage(judged.where("rejected").select("doc_id", F.col(key).alias("_bad")).distinct(), "rejected"), F.lit(24))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["doc_id"]) & (F.xxhash64(docs["text"]) == bad["_bad"]), "left_anti")
