"""Operator 3: a compression classifier.

Two zstandard dictionaries are trained, on labelled good and on labelled bad text. A text is compressed in blocks with
each of them and with none; the difference of the two sizes over the plain size, of the whole text and of its worst block, with how far the text
shrinks and how long it is beside them, is what a small logistic model calibrates to the probability of label 1 (the difference alone ranks
less well: see README). Blocks keep a long text from outgrowing the dictionaries: all of it is compressed.

Labels come only from rows whose crc32(doc_id as text) mod 5 is not 0, and language, source and ids are no
inputs. The fit takes a bounded sample of them: for each label the FIT_DOCS documents of the smallest hash, as far as they add up to
FIT_BYTES of text, half for dictionaries, half for calibration. Both labels are counted over all learnable rows, and the calibration rows of a label weigh
what that label has in all: the scores keep the true base rate, whether or not the bound bites.

Defined results: null and empty texts get the share of label 1 among all learnable rows; a null doc_id is not held out and not learnt from; a label that isn't 0 or 1,
or is null, isn't learnt from; several labels of one document count as they stand; with one class only, every score is that class's
rate; without labels it is 0.5; rows that repeat a doc_id are scored each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import steps, table, tune

#: Bound of the fit: documents of each label.
FIT_DOCS = 3000
#: Bound of the fit: bytes of text of each label.
FIT_BYTES = 32 << 20
#: Bytes of a document that one task compresses at a time.
BLOCK = 2048
DICTIONARY = 64 << 10
LEVEL = 3
THRESHOLD = 0.3
OUT = "doc_id long, held_out boolean, score double, predicted int"


class Compressors:
    """Sizes of blocks without and with each dictionary."""

    def __init__(self, dictionaries: list[bytes]):
        import zstandard

        self.all = [zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)]
        self.all += [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False) for d in dictionaries]

    def features(self, text: str | None) -> list[float]:
        data = (text or "").encode("utf-8", "surrogatepass")
        if not data:
            return [0.0] * N_FEATURES  # not scored: see classify
        sizes = np.array([[len(c.compress(data[at : at + BLOCK])) for c in self.all] for at in range(0, len(data), BLOCK)], float)
        length = np.minimum(BLOCK, len(data) - BLOCK * np.arange(len(sizes)))
        plain, good, bad = sizes.T
        share = (bad - good) / np.maximum(plain, 1)
        # Short blocks at the end carry little; each block counts by its length.
        total = float((bad - good).sum() / plain.sum())
        shrunk = np.log(plain.sum() / len(data))
        full = length >= BLOCK // 4
        worst = float(share[full].min()) if full.any() else total
        least = float(np.log((plain / length)[full].min())) if full.any() else shrunk
        return [total, worst, float(shrunk), least, 1.0 / np.sqrt(len(data))]


N_FEATURES = 5


def quadratic(x: np.ndarray) -> np.ndarray:
    """Intercept, features, and their products."""
    i, j = np.triu_indices(x.shape[1])
    return np.concatenate([np.ones((len(x), 1)), x, x[:, i] * x[:, j]], axis=1)


class Model:
    def __init__(self, dictionaries: list[bytes], centre: np.ndarray, scale: np.ndarray, weights: np.ndarray, rate: float):
        self.dictionaries, self.centre, self.scale, self.weights, self.rate = dictionaries, centre, scale, weights, rate

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = quadratic(np.clip((features - self.centre) / self.scale, -6, 6)) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Constant:
    dictionaries: list[bytes] = []

    def __init__(self, rate: float):
        self.rate = rate


def train(good: list[str], bad: list[str], counts: tuple[int, int] | None = None) -> Model | Constant:
    """Dictionaries from every other document of each class, calibration on the others, weighed to the classes' counts (good, bad)."""
    if not good or not bad:
        return Constant(1.0 if good else 0.0 if bad else 0.5)
    dictionaries = [dictionary(x[::2]) for x in (good, bad)]
    c = Compressors(dictionaries)
    own = [good[1::2] or good, bad[1::2] or bad]
    raw, y = np.array([c.features(t) for x in own for t in x]), np.repeat([1.0, 0.0], [len(x) for x in own])
    # The weights add up to the rows, so the ridge counts as much as without them.
    part = np.array(counts or (len(good), len(bad)), float)
    weight = np.repeat(part / part.sum() * len(y) / [len(x) for x in own], [len(x) for x in own])
    centre, scale = raw.mean(0), raw.std(0) + 1e-6
    x = quadratic(np.clip((raw - centre) / scale, -6, 6))
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], 1.0)
    ridge[0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return Model(dictionaries, centre, scale, w, float(part[0] / part.sum()))


def dictionary(texts: list[str]) -> bytes:
    """Trained on blocks as they will be compressed; plain content where there is too little to train on."""
    import zstandard

    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    samples = [d[at : at + BLOCK] for d in data for at in range(0, len(d), BLOCK)]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return (b"\n".join(samples) or b" ")[:DICTIONARY]


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCS, most_bytes: int = FIT_BYTES) -> Model | Constant:
    """A model from at most `most` documents and `most_bytes` of each label (a text of over a quarter of these is passed over), those with the smallest hashes of their ids, at the rate of all learnable rows."""
    learnt = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter("quality in (0, 1) and crc32(cast(doc_id as string)) % 5 <> 0")
    with_text = docs.filter("length(cast(text as string)) > 0").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count("*").alias("rows"))
    both = learnt.groupBy("doc_id", "quality").agg(F.count("*").alias("labels")).join(with_text, "doc_id").groupBy("quality").agg(F.sum(F.col("rows") * F.col("labels")).alias("n"))
    counts = {r.quality: r.n for r in both.collect()}
    texts = []
    for label in (1, 0):
        # FIT_DOCS ids are few: they find their texts by a broadcast join, and only these texts, up to FIT_BYTES, come to the driver.
        ids = learnt.filter(F.col("quality") == label).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id").filter("length(text) > 0")
        first = rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(most)
        # Running sums over at most `most` rows: longer texts than the bound leaves room for are passed over.
        so_far = F.sum(F.octet_length("text")).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, 0))
        texts.append([r.text for r in first.filter(F.octet_length("text") <= most_bytes // 4).withColumn("_sum", so_far).filter(F.col("_sum") <= most_bytes).select("text").collect()])
    return train(*texts, (counts.get(1, 0), counts.get(0, 0)))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, most: int = FIT_DOCS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    tune(spark)
    model = spark.sparkContext.broadcast(fit(docs, labels, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        c = Compressors(own.dictionaries) if own.dictionaries else None
        for batch in steps(batches):
            texts = batch.column(2).to_pylist()
            score = np.full(len(texts), own.rate)
            some = [k for k, t in enumerate(texts) if t]
            if c and some:
                score[some] = own.scores(np.array([c.features(texts[k]) for k in some]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(run, OUT)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
