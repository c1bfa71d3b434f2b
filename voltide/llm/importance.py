"""Target-distribution importance resampling over hashed n-grams.

A text is read as UTF-8 bytes. One 256-byte table lower-cases A-Z and blanks every other ASCII character that is neither a letter
nor a digit, ``bytes.split`` yields the words, and the CRC-32 of an n-gram (its words joined by one space) grows out of that of
the n-gram before it, as ``crc32(b" " + word, crc)``. Its remainder by ``buckets`` is its bucket. Counters reduce
words or n-grams first within a text and then within a batch, and every task adds up one array with a count per bucket, so
only bucket totals are shuffled.

The gain of a bucket is the floored thousandfold logarithm of its smoothed frequency in the target over that in the
documents, the weight of a document the floored mean of its features' gains, and its score the weight with Gumbel noise from a hash
of its id. Drawing the highest scores is then resampling without replacement by importance. The histogram of the (whole)
scores gives the score at which the draw ends; only rows from there on are sorted, by range over all partitions.

Null and empty texts have no features and weight 0; they are scored, and drawn only if ``min_words`` is 0. A null id
is hashed as the empty text and sorts last among ties. Ties go to the smaller id, then to more features and greater weight;
repeated rows are drawn one by one. Empty tables of documents or targets are allowed: counts are then 0. ``weigh`` reads id and text only, so
other columns cannot clash; ``resample`` refuses a clash with its own columns.
"""

from __future__ import annotations

import functools
import hashlib
import math
import operator
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.llm.tables import free_name, positions
from voltide.session import stage

BUCKETS, NGRAM, MIN_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
SEEN = 1 << 16
WEIGHED = "id {id}, n_words long, n_features long, weight long, score long"


def _table() -> bytes:
    """Letters in lower case, digits and bytes from 128 as they are, all else a blank."""
    low = bytes(range(256)).lower()
    return bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in low)


TABLE = _table()


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TABLE).split()


class Buckets:
    """Buckets of a text's n-grams. The CRC-32 of single words is remembered for at most ``SEEN`` words."""

    def __init__(self, buckets: int, ngram: int):
        self.buckets, self.ngram = buckets, ngram
        self.crc = functools.lru_cache(maxsize=SEEN)(zlib.crc32)

    def counted(self, found: list[bytes]) -> dict[int, int]:
        """How often each bucket is hit by the n-grams of a list of words."""
        singles = Counter(found)
        hits: Counter[int] = Counter()
        for word, times in singles.items():
            hits[self.crc(word) % self.buckets] += times
        if self.ngram > 1:
            spaced = [b" " + word for word in found]
            prints = [self.crc(word) for word in found]
            for length in range(2, self.ngram + 1):
                prints = [zlib.crc32(word, seed) for word, seed in zip(spaced[length - 1 :], prints)]
                hits.update(value % self.buckets for value in prints)
        return hits

    def features(self, n_words: int) -> int:
        return sum(max(n_words - length, 0) for length in range(self.ngram))


def bucket_counts(rows: DataFrame, text: str, buckets: int, ngram: int) -> np.ndarray:
    """How often each bucket occurs in all texts. One row per task and bucket is shuffled, one per bucket collected."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, total = Buckets(buckets, ngram), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            hits: Counter[int] = Counter()
            for body in batch.column(0).to_pylist():
                hits.update(made.counted(words(body)))
            if hits:
                total[list(hits)] += list(hits.values())
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(total[used])], ["bucket", "n"])

    bodies = rows.select(F.col(text).cast("binary").alias("body"))
    sums = bodies.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(buckets, dtype=np.int64)
    total[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return total


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """The gain of every bucket from its counts among the documents and in the target."""
    buckets = len(source)
    whole, aimed = float(source.sum() + buckets), float(target.sum() + buckets)
    return [
        math.floor(1000 * math.log(((t + 1) * whole) / ((s + 1) * aimed)))
        for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist(), strict=True)
    ]


def noise(seed: int, id: object) -> int:
    head = int(hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((head + 0.5) / 4294967296)))


def weigh(
    docs: DataFrame,
    target: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
    ngram: int = NGRAM,
    seed: int = SEED,
) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every document against the texts of ``target``."""
    gain = gains(bucket_counts(docs, text, buckets, ngram), bucket_counts(target, text, buckets, ngram))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Buckets(buckets, ngram)
        for batch in batches:
            out: list[list[int]] = [[], [], [], []]
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = words(body)
                n, hits = made.features(len(found)), made.counted(found)
                mean = sum(map(operator.mul, map(gain.__getitem__, hits), hits.values())) // n if n else 0
                for column, value in zip(out, (len(found), n, mean, mean + noise(seed, key)), strict=True):
                    column.append(value)
            columns = [batch.column(0), *(pa.array(column, type=pa.int64()) for column in out)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("body"))
    return rows.mapInArrow(score, WEIGHED.format(id=docs.schema[id].dataType.simpleString()))


def ranked(weighed: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """The weighed rows with ``rank`` from 1 for those that are drawn, null for the others."""
    eligible = F.col("n_words") >= min_words
    by_score = weighed.filter(eligible).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    scores = by_score.orderBy(F.desc("score")).toArrow()
    counts = scores["n"].to_numpy()
    wanted = percent * int(counts.sum()) // 100
    if not wanted:
        return weighed.withColumn("rank", F.lit(None).cast("long"))
    ends = int(np.searchsorted(np.cumsum(counts), wanted))
    last = scores["score"][ends].as_py()
    near = eligible & (F.col("score") >= last)
    order = [F.desc("score"), F.asc_nulls_last("id"), F.desc("n_features"), F.desc("weight")]
    placed = positions(weighed.filter(near), order, "ranked-documents")
    place = F.when(F.col("position") < wanted, F.col("position") + 1)
    drawn = placed.withColumn("rank", place).drop("position")
    return drawn.unionByName(weighed.filter(~near).withColumn("rank", F.lit(None).cast("long")))


def draw(
    docs: DataFrame,
    target: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    ngram: int = NGRAM,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: id, n_words, n_features, weight, score, rank."""
    weighed = stage(weigh(docs, target, id, text, buckets, ngram, seed), "weighed-documents")
    return ranked(weighed, percent, min_words).withColumnRenamed("id", id)


def resample(docs: DataFrame, target: DataFrame, id: str = "doc_id", **settings) -> DataFrame:
    """The drawn documents with all their columns and their ``rank``; ids are unique and not null."""
    if "rank" in {c.lower() for c in docs.columns}:
        raise ValueError("the input has a column rank")
    mark = free_name(docs.columns, "drawn_id")
    chosen = draw(docs, target, id, **settings).filter("rank IS NOT NULL").select(F.col(id).alias(mark), "rank")
    return docs.join(chosen, F.col(id) == F.col(mark)).drop(mark)
