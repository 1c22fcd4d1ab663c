"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams and of the whole word, a text the mean of
its words, and a softmax layer on top is trained together with the vectors, so a
misspelling never seen shares most of its n-grams with the word it hides. After training every
subword has one number, its vector times the difference of the class weights; scoring a
text averages these numbers, and every distinct word is scored once per task.
"""

from __future__ import annotations

import tempfile
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoloom.llm.text import blocks, map_batches, mix, texts_of
from cytoloom.session import stored

# Labelled documents the model is fitted on, drawn by hash; scoring covers every row.
MAX_TRAINING_ROWS = 8_000
# Hashed subwords with a vector each.
BUCKET_BITS = 17
DIMENSIONS = 8
GRAMS = (3, 4, 5, 6)
EPOCHS = 10
RATE = 0.25
# Predicted toxic from this score on.
THRESHOLD = 0.3
# Distinct words whose score a task remembers.
REMEMBERED_WORDS = 200_000


def remainder(column: str, modulus: int) -> Column:
    """crc32 of a number as text, modulo; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of each word, and the word each belongs to."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    points = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    left = ends[owner] - np.arange(len(points))
    rolled = np.zeros(len(points), np.uint64)
    buckets, owners = [], []
    shift = np.uint64(64 - BUCKET_BITS)
    for n in range(1, max(GRAMS) + 1):
        m = len(points) - n + 1
        if m <= 0:
            break
        rolled = mix(rolled[:m] + points[n - 1 :] + np.uint64(n))
        if n in GRAMS:
            at = np.flatnonzero(left[:m] >= n)
            buckets.append(rolled[at] >> shift)
            owners.append(owner[at])
    # the word itself, as a hash of its letters and their places
    place = np.arange(len(points), dtype=np.int64) - (ends - lengths)[owner]
    whole = np.add.reduceat(mix(points * np.uint64(0x100000001B3) + place.astype(np.uint64)), ends - lengths)
    buckets.append(mix(whole) >> shift)
    owners.append(np.arange(len(words)))
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text as buckets (int32) and their weights (float32) that sum to one; empty without words."""
    words: dict[str, int] = {}
    for w in text.lower().split():
        words[w] = words.get(w, 0) + 1
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    buckets, owners = subwords(list(words))
    counts = np.fromiter(words.values(), np.float64, len(words))
    share = counts / counts.sum() / np.bincount(owners, minlength=len(words))
    weights = np.bincount(buckets, share[owners], 1 << BUCKET_BITS)
    at = np.flatnonzero(weights)
    return at.astype(np.int32), weights[at].astype(np.float32)


class Bags:
    """The bags of many texts, in an unnamed temporary file of the task that ends with it."""

    def __init__(self):
        self.file, self.ends = tempfile.TemporaryFile(), array("q", [0])

    def __enter__(self) -> Bags:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def __len__(self) -> int:
        return len(self.ends) - 1

    def add(self, text: str) -> None:
        at, weights = bag(text)
        self.file.write(at.tobytes())
        self.file.write(weights.tobytes())
        self.ends.append(self.ends[-1] + at.nbytes + weights.nbytes)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        self.file.seek(self.ends[i])
        data = self.file.read(self.ends[i + 1] - self.ends[i])
        return np.frombuffer(data, np.int32, len(data) // 8), np.frombuffer(data, np.float32, offset=len(data) // 2)


def fit(bags: Bags, toxic: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """One number per subword bucket and the bias, from vectors and softmax trained together."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-0.1, 0.1, (1 << BUCKET_BITS, DIMENSIONS))
    layer = rng.uniform(-0.1, 0.1, (DIMENSIONS, 2))
    share = np.clip((toxic.sum() + 0.5) / (len(toxic) + 1.0), 1e-6, 1 - 1e-6)
    bias = np.log(np.array([1 - share, share]))
    v2, l2, b2 = np.full(len(vectors), 1e-10), np.full(layer.shape, 1e-6), np.full(2, 1e-6)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(bags)):
            at, weights = bags[i]
            hidden = weights @ vectors[at] if len(at) else np.zeros(DIMENSIONS)
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            error = p / p.sum()
            error[int(toxic[i])] -= 1
            b2 += error * error
            bias -= 0.1 * rate * error / np.sqrt(b2)
            if not len(at):
                continue
            back = layer @ error
            step = np.outer(hidden, error)
            l2 += step * step
            layer -= rate * step / np.sqrt(l2)
            # one adaptive rate per bucket, as common buckets get far more steps
            v2[at] += weights * weights * (back @ back) / DIMENSIONS
            vectors[at] -= (rate * weights / np.sqrt(v2[at]))[:, None] * back
    return vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0])


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Fit on at most MAX_TRAINING_ROWS labelled documents whose crc32(doc_id) mod 4 is not 2.

    The fit runs in one task over that bounded sample, whose bags wait in a temporary file. Rows without id or label are left out; a
    doc_id labelled both ways counts as toxic. Without labelled documents every score is 0.
    """
    chosen = stored(
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (remainder("doc_id", 4) != 2))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MAX_TRAINING_ROWS),
        "labelled",
    )
    sample = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
        .repartition(1)
        .sortWithinPartitions("doc_id")
    )

    def run(batches):
        toxic = []
        with Bags() as bags:
            for batch in batches:
                toxic += batch.column("toxic").to_pylist()
                for text in texts_of(batch):
                    bags.add(text)
            if not toxic:
                return
            numbers, bias = fit(bags, np.array(toxic) > 0)
        yield pa.RecordBatch.from_arrays([pa.array([numbers.astype(np.float32).tobytes()]), pa.array([bias])], ["numbers", "bias"])

    model = map_batches(sample, run, "numbers binary, bias double").collect()  # one row of fixed size
    if not model:
        return np.zeros(1 << BUCKET_BITS, np.float32), -np.inf
    return np.frombuffer(bytes(model[0][0]), np.float32), model[0][1]


class Scorer:
    """Scores of whole texts; remembers words already met."""

    def __init__(self, numbers: np.ndarray, bias: float):
        self.numbers, self.bias, self.words = numbers, bias, {}

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.words]
        if len(self.words) + len(new) > REMEMBERED_WORDS:
            self.words.clear()
            new = list(words)
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            buckets, owners = subwords(part)
            sums = np.bincount(owners, self.numbers[buckets], len(part)) / np.bincount(owners, minlength=len(part))
            self.words.update(zip(part, sums.tolist()))

    def scores(self, texts: list[str]) -> np.ndarray:
        split = [t.lower().split() for t in texts]
        self.learn(set().union(*split))
        value = self.words.__getitem__
        means = [sum(map(value, words)) / len(words) if words else 0.0 for words in split]
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-(np.array(means) + self.bias)))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs(doc_id, text)``.

    Whole texts are scored; a null or empty text gets the score of the bias. ``held_out`` is
    true when crc32(doc_id as text) mod 4 is 2, false for a null doc_id. Repeated rows return
    a row each, other columns are ignored, an empty table gives an empty table.
    """
    numbers, bias = train(docs, labels)

    def run(batches):
        scorer = Scorer(numbers, bias)
        for batch in batches:
            for block in blocks(batch):
                s = scorer.scores(texts_of(block))
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), block.column("held_out"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "text",
    )
    return map_batches(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score stays below the threshold, all columns kept."""
    numbers, bias = train(docs, labels)

    def run(batches):
        scorer = Scorer(numbers, bias)
        for batch in batches:
            for block in blocks(batch):
                yield block.filter(pa.array(scorer.scores(texts_of(block)) < THRESHOLD))

    return map_batches(docs, run, docs.schema)
