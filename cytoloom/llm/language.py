"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

The n-grams of one to three letters of the lower-cased text are hashed. Document frequencies are counted over all training
documents. The weights are learnt by follow-the-regularised-leader with an elastic-net penalty, which
leaves most of them at zero, on a bounded sample; the temperature of the softmax is then fitted on sample rows
kept aside, so that a score is the share of right answers among predictions with that score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoloom.llm.text import blocks, map_batches, texts_of
from cytoloom.llm.toxicity import remainder
from cytoloom.session import stored

# Training rows per language and in all, drawn by hash; document frequencies cover all training rows.
ROWS_PER_LANGUAGE = 1_000
MAX_TRAINING_ROWS = 20_000
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
GRAMS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
EPOCHS = 3
UNKNOWN = "und"

_MULTIPLIER = np.uint32(0x9E3779B1)


def gram_counts(texts: list[str]):
    """For every text the number of n-grams of each bucket, from all its letters."""
    for text in texts:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        counts = np.zeros(BUCKETS, np.float32)
        rolled = np.zeros(len(points), np.uint32)
        for n in range(1, GRAMS + 1):
            m = len(points) - n + 1
            if m <= 0:
                break
            rolled = (rolled[:m] ^ points[n - 1 :]) * _MULTIPLIER
            rolled ^= rolled >> np.uint32(15)
            counts += np.bincount(rolled >> np.uint32(32 - BUCKET_BITS), minlength=BUCKETS)
        yield counts


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of damped counts times inverse document frequency, with length one."""
    x = np.log1p(counts) * idf
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def fit(texts: list[str], langs: np.ndarray, classes: int, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights (buckets x classes), biases and temperature."""
    order = np.random.default_rng(11).permutation(len(texts))
    aside = order[: len(order) // 5] if len(order) >= 20 else order[:0]
    learn = order[len(aside) :]

    def rows_of(chosen):
        for at in range(0, len(chosen), 64):
            part = chosen[at : at + 64]
            x = tf_idf(np.array(list(gram_counts([texts[i] for i in part]))), idf)
            for i, row in zip(part, x):
                f = np.flatnonzero(row)
                yield langs[i], f, row[f].astype(np.float64)

    samples = list(rows_of(learn))
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))  # the last row is the bias

    def weights(zf, nf):
        return np.where(np.abs(zf) <= L1, 0.0, (np.sign(zf) * L1 - zf) / ((BETA + np.sqrt(nf)) / ALPHA + L2))

    rng = np.random.default_rng(12)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(samples)):
            y, f, v = samples[i]
            f, v = np.append(f, BUCKETS), np.append(v, 1.0)
            zf, nf = z[f], n[f]
            w = weights(zf, nf)
            s = v @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = v[:, None] * p
            sigma = (np.sqrt(nf + g * g) - np.sqrt(nf)) / ALPHA
            z[f] = zf + g - sigma * w
            n[f] = nf + g * g
    w = weights(z, n)
    held = [(y, v @ w[f] + w[BUCKETS]) for y, f, v in rows_of(aside)]
    if not held:
        return w[:BUCKETS], w[BUCKETS], 1.0
    y, s = np.array([a for a, _ in held]), np.array([b for _, b in held])

    def loss(log_t: float) -> float:
        u = s / np.exp(log_t)
        u = u - u.max(1, keepdims=True)
        return float((np.log(np.exp(u).sum(1)) - u[np.arange(len(y)), y]).mean())

    low, high = np.log(0.02), np.log(20.0)  # golden section; the loss has one minimum
    ratio = (np.sqrt(5) - 1) / 2
    for _ in range(50):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return w[:BUCKETS], w[BUCKETS], float(np.exp((low + high) / 2))


def train(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, float]:
    """Languages, idf, weights, biases and temperature from rows whose crc32(doc_id) mod 5 is not 0 and whose
    lang and text are not null."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder("doc_id", 5) != 0))

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        n = 0
        for batch in batches:
            for block in blocks(batch):
                for c in gram_counts(texts_of(block)):
                    total += c > 0
                    n += 1
        total = np.append(total, n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    frequency = np.zeros(BUCKETS + 1, np.int64)
    counted = map_batches(rows.select("text"), count, "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    for bucket, n in counted.collect():  # one row per bucket at most
        frequency[bucket] = n
    idf = np.log((1 + frequency[BUCKETS]) / (1 + frequency[:BUCKETS])).astype(np.float32) + 1

    draw = Window.partitionBy("lang").orderBy("draw", "doc_id")
    ids = (
        rows.select("doc_id", "lang", F.xxhash64("doc_id").alias("draw"))
        .withColumn("rank", F.row_number().over(draw))
        .where(F.col("rank") <= ROWS_PER_LANGUAGE)
        .orderBy("rank", "draw", "doc_id")
        .limit(MAX_TRAINING_ROWS)
        .select("doc_id", "lang")
    )
    ids = stored(ids.distinct(), "sampled")
    sample = rows.join(F.broadcast(ids), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    langs = sorted(r[0] for r in ids.select("lang").distinct().collect())
    if not langs:
        return [], idf, np.zeros((BUCKETS, 0)), np.zeros(0), 1.0

    def run(batches):
        texts, y = [], []
        for batch in batches:
            texts += texts_of(batch)
            y += [langs.index(x) for x in batch.column("lang").to_pylist()]
        if texts:
            w, b, t = fit(texts, np.array(y), len(langs), idf)
            yield pa.RecordBatch.from_arrays([pa.array([w.astype(np.float32).tobytes()]), pa.array([b.tobytes()]), pa.array([t])], ["w", "b", "t"])

    sample = sample.repartition(1).sortWithinPartitions("doc_id", "lang")
    w, b, t = map_batches(sample, run, "w binary, b binary, t double").first()  # one row of fixed size
    w = np.frombuffer(bytes(w), np.float32).reshape(BUCKETS, len(langs))
    return langs, idf, w, np.frombuffer(bytes(b)), t


def predict(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs(doc_id, text, lang)``.

    Learnt from the rows of ``train``; predictions see the text alone. A text that is null or has no letter is
    ``und`` with score 0, and so is every text when there is nothing to learn from. ``held_out`` is true when
    crc32(doc_id as text) mod 5 is 0, false for a null doc_id. Repeated rows return a row each, other columns are
    ignored, an empty table gives an empty table.
    """
    langs, idf, w, b, t = train(docs)

    def run(batches):
        for batch in batches:
            for block in blocks(batch):
                texts = texts_of(block)
                lang, score = [], []
                counts = gram_counts(texts)
                for at in range(0, len(texts), 64):
                    part = texts[at : at + 64]
                    x = tf_idf(np.array([next(counts) for _ in part]), idf)
                    s = (x @ w + b) / t
                    p = np.exp(s - s.max(1, keepdims=True, initial=-np.inf))
                    p /= p.sum(1, keepdims=True)
                    for text, row in zip(part, p):
                        known = bool(langs) and any(map(str.isalpha, text))
                        lang.append(langs[int(row.argmax())] if known else UNKNOWN)
                        score.append(float(row.max()) if known else 0.0)
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), block.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "text"
    )
    return map_batches(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")
