"""Supervised subword embeddings for document quality.

A document is a bag of features: its words, their character n-grams, a mark for every word that ends a three-word phrase
seen before in the same text or equals the word before it, and a closing mark. Each feature is hashed to one of ``buckets`` rows of a learned table;
the rows are averaged and a softmax over the average gives the score. Table and output are trained by stochastic gradient
descent in numpy.

Training uses at most ``max_rows`` labelled documents, those with the smallest hash of their id, so the sample is
the same at every run and its size has a bound whatever the corpus; it fits one task. Scoring reads every whole text in the
tasks that hold it and shuffles nothing: the output layer is linear, so a word's share of the score is one number, which
each worker remembers for a bounded number of words.

Null texts count as empty; an empty text has only the closing mark and gets a score too. Labels that are null are not used;
of several labels of one id the largest counts. Without usable labels every score is 0.5. Only ``doc_id`` and ``text``
of the documents are read, and of these only the text is a feature. Repeated rows get equal scores, missing ids are held out.
"""

from __future__ import annotations

import functools
import io
import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 8192
THRESHOLD = 0.3
REMEMBERED_WORDS = 1 << 18
LONGEST_REMEMBERED = 40
CLOSING, AGAIN, TWICE = "\x02end", "\x02again", "\x02twice"


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    dim: int = 16
    shortest: int = 3
    longest: int = 5
    epochs: int = 5
    rate: float = 0.5
    seed: int = 7


def features_of(word: str, settings: Settings) -> list[int]:
    """Rows of a word and of the character n-grams of the marked word; a long word has all of them."""
    marked, crc, buckets = f"<{word}>", zlib.crc32, settings.buckets
    spans = [(at, at + n) for n in range(settings.shortest, settings.longest + 1) for at in range(len(marked) - n + 1)]
    rows = [crc(f"\x01{word}".encode()) % buckets]
    if marked.isascii():
        data = marked.encode()
        return rows + [crc(data[a:b]) % buckets for a, b in spans]
    return rows + [crc(marked[a:b].encode()) % buckets for a, b in spans]


@functools.cache
def crc_table() -> np.ndarray:
    """What CRC-32 makes of each byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ np.where(table & 1, np.uint32(0xEDB88320), np.uint32(0))
    return table


def rows_of_words(words: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(rows, sizes): the rows of ``features_of`` of many words, word by word, and how many each word has.

    The checksums of all n-grams grow together, by one character at every place of the joined words.
    """
    data = np.frombuffer("".join([f"<{word}>" for word in words]).encode(), np.uint8)
    at = np.flatnonzero(data & 0xC0 != 0x80)  # first byte of each character
    widths = np.diff(at, append=len(data))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(lengths) - lengths
    left = np.repeat(starts + lengths, lengths) - np.arange(len(at))  # characters from here to the end of the word
    lasting, table = settings.longest, crc_table()
    first = np.concatenate((data[at], np.zeros(lasting, np.uint8)))
    wider = [(k, np.flatnonzero(widths > k)) for k in range(1, int(widths.max()))]
    rows = np.zeros((len(at), 2 + lasting - settings.shortest), np.int32)
    used = np.zeros(rows.shape, bool)
    rows[starts, 0] = [zlib.crc32(b"\x01" + word.encode()) % settings.buckets for word in words]
    used[starts, 0] = True
    sums = np.full(len(at), 0xFFFFFFFF, np.uint32)
    for n in range(1, lasting + 1):
        sums = table[(sums ^ first[n - 1 : n - 1 + len(at)]) & 0xFF] ^ (sums >> 8)
        for k, of in wider:  # further bytes of the character that lies n - 1 behind
            of = of[np.searchsorted(of, n - 1) :]
            here = of - (n - 1)
            sums[here] = table[(sums[here] ^ data[at[of] + k]) & 0xFF] ^ (sums[here] >> 8)
        if n >= settings.shortest:
            column = 1 + n - settings.shortest
            rows[:, column] = (sums ^ np.uint32(0xFFFFFFFF)) % np.uint32(settings.buckets)
            used[:, column] = left >= n
    return rows[used], np.add.reduceat(used.sum(axis=1), starts)


def tokens_of(text: str) -> list[str]:
    """Words of a text, a mark per word that ends a phrase seen before or repeats its neighbour, the closing mark."""
    words = text.split()
    again = max(0, len(words) - 2) - len(set(zip(words, words[1:], words[2:])))
    twice = sum(map(operator.eq, words, words[1:]))
    return [*words, *[AGAIN] * again, *[TWICE] * twice, CLOSING]


def counted(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(rows, times) of a text, in small integers."""
    words = Counter(tokens_of(text))
    rows, sizes = rows_of_words(list(words), settings)
    times = np.repeat(np.fromiter(words.values(), np.int64), sizes)
    found, at = np.unique(rows, return_inverse=True)
    n = np.bincount(at, weights=times)
    return found, n.astype(np.min_scalar_type(int(n.max())))


def weights_of(times: np.ndarray) -> np.ndarray:
    return (times / times.sum(dtype=np.int64)).astype(np.float32)


def bag(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(rows, weights) of a text; the weights add up to 1."""
    rows, times = counted(text, settings)
    return rows, weights_of(times)


@dataclass
class Model:
    table: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    settings: Settings

    def row_scores(self) -> np.ndarray:
        """What one row adds to the log odds of label 1."""
        return self.table @ (self.output[:, 1] - self.output[:, 0])

    def log_odds_at_zero(self) -> float:
        return float(self.bias[1] - self.bias[0])

    def to_bytes(self) -> bytes:
        buffer = io.BytesIO()
        np.savez(buffer, table=self.table.astype(np.float16), output=self.output, bias=self.bias)
        return buffer.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes, settings: Settings) -> Model:
        held = np.load(io.BytesIO(data))
        return cls(held["table"].astype(np.float32), held["output"], held["bias"], settings)


def untrained(settings: Settings) -> Model:
    random = np.random.default_rng(settings.seed)
    table = random.uniform(-1, 1, (settings.buckets, settings.dim)).astype(np.float32) / settings.dim
    return Model(table, np.zeros((settings.dim, 2), np.float32), np.zeros(2, np.float32), settings)


def train(texts: list[str], labels: list[int], settings: Settings) -> Model:
    """Stochastic gradient descent, one document a step, the rate falling to zero."""
    model = untrained(settings)
    bags = [counted(text, settings) for text in texts]
    random = np.random.default_rng(settings.seed)
    steps, done = settings.epochs * len(bags), 0
    for _ in range(settings.epochs):
        for at in random.permutation(len(bags)):
            rate = settings.rate * (1 - done / steps)
            rows, times = bags[at]
            weights = weights_of(times)
            held = model.table[rows]
            average = weights @ held
            logits = average @ model.output + model.bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[labels[at]] -= 1
            pull = model.output @ error
            model.output -= rate * np.outer(average, error)
            model.bias -= rate * error
            # Each row is moved as far as its part of the bag, scaled up as rows of long texts have tiny parts.
            model.table[rows] = held - rate * np.outer(weights / weights.max(), pull)
            done += 1
    return model


def held_out(id: Column) -> Column:
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` labelled documents that are not held out."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    chosen = (
        known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    settings: Settings = Settings(),
    max_rows: int = MAX_ROWS,
) -> Model:
    """Train in one task on the bounded sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(
            row
            for batch in batches
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "label")), strict=True)
        )
        if rows:
            model = train([text for _, text, _ in rows], [int(n > 0) for *_, n in rows], settings)
            yield pa.RecordBatch.from_arrays([pa.array([model.to_bytes()], type=pa.binary())], names=["model"])

    gathered = sample(docs, labels, label, max_rows).coalesce(1)
    trained = gathered.mapInArrow(run, "model binary").collect()
    return Model.from_bytes(bytes(trained[0]["model"]), settings) if trained else untrained(settings)


def scorer(model: Model):
    """Text to probability of label 1."""
    per_row, zero, settings = model.row_scores(), model.log_odds_at_zero(), model.settings
    known: dict[str, complex] = {}  # score and number of rows of a word, as one number that sums fast

    def remember(words: list[str]) -> None:
        rows, sizes = rows_of_words(words, settings)
        sums = np.add.reduceat(per_row[rows].astype(np.float64), np.cumsum(sizes) - sizes)
        known.update(zip(words, (sums + 1j * sizes).tolist(), strict=True))

    def score(text: str) -> float:
        words = tokens_of(text)
        fresh = set(words).difference(known)
        if len(known) + len(fresh) > REMEMBERED_WORDS:
            known.clear()
            fresh = set(words)
        if fresh:
            remember(list(fresh))
        total = sum(map(known.__getitem__, words))
        for word in fresh:
            if len(word) > LONGEST_REMEMBERED:
                del known[word]
        return float(1 / (1 + np.exp(-np.clip(total.real / total.imag + zero, -60, 60))))

    return score


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(shared.value)
        for batch in batches:
            scores = [score(text.as_py() or "") for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, type=pa.float64())],
                names=["doc_id", "held_out", "score"],
            )

    read = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string"))
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double"
    return read.mapInArrow(run, kinds).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, all columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(shared.value)
        for batch in batches:
            yield batch.filter(pa.array([score(text.as_py() or "") >= threshold for text in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
