"""Best-fit packing of token runs into sequences of bounded length.

Every document is its token ids and a closing id. Longer documents are cut into pieces of ``capacity`` tokens, the first
of which is the shorter one; full pieces fill a sequence each. The other pieces are packed best-fit in bulk:

* documents are sorted into size classes (a class per length, at most ``capacity`` of them), open sequences into
  gap classes;
* a sweep from long to short gives each size class its successor, the smallest gap class that still holds it; as many
  sequences of that class as there are documents take one, or several where more fit, and move on to the class of what
  is left of them; when no gap holds a size, new sequences open; this repeats until all classes are placed;
* which document gets which place is settled by rank: the k-th document of a size takes the k-th place for it.

The sweep works on counts: a few thousand classes, however many documents there are, so the driver sees a histogram
and no row. Ranks are taken within salted parts of a size class, so that a length that a third of the documents have is
not numbered in one task. Places are looked up with one join on (size, rank interval); the number of intervals is
bounded by the classes, not by the documents.

Null and empty texts are the closing id alone. Repeated rows are packed each on their own; a null id is kept. Extra columns
are not read. An empty table gives an empty result. A text of any length is one row in one task.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltide.llm.encoding import tokenizer_file
from voltide.session import stage

CAPACITY = 2048
RANK_PART = 100_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a run of ``n`` tokens."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(
    docs: DataFrame,
    json_path: str,
    ranks_path: str,
    capacity: int = CAPACITY,
    closing: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of every document with the checksum of their ids, and the ids themselves if wanted."""
    end = np.asarray([closing], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = tokenizer_file(json_path, ranks_path)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = codec.encode(text.as_py() or "") + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, k, start, length, zlib.crc32(part), *([part] if with_ids else [])))
            columns = list(zip(*rows, strict=True)) or [()] * (5 + with_ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=names
            )

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if with_ids else [])]
    schema = PIECES + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def sweep(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Place size classes best-fit, long sizes first.

    Returns places as (size, first rank, last rank + 1, per sequence, first sequence, offset): the documents of these
    ranks go, ``per sequence`` at a time, to consecutive sequences, from ``offset`` on.
    """
    places: list[tuple[int, int, int, int, int, int]] = []
    open_at: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs (first sequence, how many)
    gaps: list[int] = []
    next_sequence = 0

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if not open_at[gap]:
                bisect.insort(gaps, gap)
            open_at[gap].append((first, n))

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect.bisect_left(gaps, size)
            if at < len(gaps):
                gap = gaps[at]
                first, n = open_at[gap].pop()
                if not open_at[gap]:
                    gaps.pop(at)
            else:
                gap, first = capacity, next_sequence
                n = -(-left // (capacity // size))
                next_sequence += n
            each = min(gap // size, left)
            full = min(n, left // each)
            places.append((size, rank, rank + full * each, each, first, capacity - gap))
            leave(gap - each * size, first, full)
            leave(gap, first + full, n - full)
            rank, left = rank + full * each, left - full * each
    return places


def pack(runs: DataFrame, capacity: int = CAPACITY, part: int = RANK_PART) -> DataFrame:
    """``runs`` (any columns, one named ``length``) with ``sequence_id`` and ``offset``."""
    spark = runs.sparkSession
    held = stage(runs, "packing-runs")
    columns = held.columns
    sizes = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if sizes and (min(sizes) < 1 or max(sizes) > capacity):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    places = spark.createDataFrame(
        sweep(sizes, capacity) or [(0, 0, 0, 1, 0, 0)],
        "size long, from_rank long, to_rank long, each long, first long, at long",
    )
    parts = spark.createDataFrame(
        [(size, max(1, -(-n // part))) for size, n in sizes.items()] or [(0, 1)], "size long, n_parts long"
    )
    # Of the rows of a size, each part is numbered alone; a row's rank is its number plus the rows of earlier parts.
    spread = F.xxhash64(*columns)
    salted = held.join(F.broadcast(parts), held["length"] == parts["size"]).withColumn(
        "_part", F.pmod(spread, F.col("n_parts"))
    )
    before = Window.partitionBy("size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        salted.groupBy("size", "_part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("size", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    )
    in_part = Window.partitionBy("size", "_part").orderBy(*columns)
    ranked = (
        salted.withColumn("_number", F.row_number().over(in_part) - 1)
        .join(offsets, ["size", "_part"])
        .withColumn("_rank", F.col("_before") + F.col("_number"))
    )
    inside = (F.col("_rank") >= F.col("from_rank")) & (F.col("_rank") < F.col("to_rank"))
    placed = ranked.join(F.broadcast(places.withColumnRenamed("size", "_size")), (F.col("size") == F.col("_size")) & inside)
    step = F.col("_rank") - F.col("from_rank")
    return placed.select(
        *columns,
        (F.col("first") + F.floor(step / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + (step % F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(
    docs: DataFrame,
    json_path: str = public_tokenizers.path("byte_bpe_50k.json"),
    ranks_path: str = public_tokenizers.path("byte_bpe_50k.tiktoken"),
    capacity: int = CAPACITY,
) -> DataFrame:
    return pack(pieces(docs, json_path, ranks_path, capacity), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Ids of each sequence as one binary, from packed pieces that carry ``ids``; a sequence holds few pieces."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return packed.groupBy("sequence_id").agg(
        F.unhex(F.array_join(F.transform(ordered, lambda p: p["ids"]), "")).alias("ids"), F.sum("length").alias("length")
    )
