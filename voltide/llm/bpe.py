"""Byte-level BPE: the distinct words of a block of texts are encoded once, by a fold over their bytes.

The JVM splits the texts into words (matches of the split pattern). A task cuts each Arrow batch into blocks of about
a million words, numbers the distinct words of a block and encodes each of them once; an occurrence only copies the ids of its
word. The most frequent words of a block, a bounded number (``remembered``), are kept for the next block of the task. So no word and no text crosses the network, and the bound limits
the memory and not the result.

A word that is a token is its own id. Any other word starts as the ids of its bytes; a step merges the leftmost pair of
lowest rank and looks up only the two pairs that the merge changed. The steps are taken for all words of one length
together, in arrays: after each step those that go on are one id shorter. A long word takes its steps alone, its pairs in a heap.

Decoding, by higher-order functions, takes each id's bytes from an array literal and concatenates them. A text with
a character that the JVM's Unicode version does not know is split by the same pattern with its letter and number
classes spelled out.

Null and empty texts have no ids. Rows are encoded one by one: repeated rows and ties get equal results, missing document
ids are kept, an empty table gives an empty result. Columns are added to those of the input; a clashing input column
must be dropped by the caller, which the function checks. One text's words and ids lie in one task.
"""

from __future__ import annotations

import functools
import heapq
import json
import sys
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from voltide.llm.encoding import read_ranks
from voltide.llm.tables import free_name

REMEMBERED = 1 << 17
BLOCK_WORDS = 1 << 20
LONG_WORD = 64
NO_MERGE = np.int32((1 << 31) - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(maxsize=1)
def spelled_out_pattern() -> str:
    """The split pattern with explicit letter and number ranges."""

    def ranges(kind: str) -> str:
        member, found = regex.compile(rf"\p{{{kind}}}"), []
        for code in range(sys.maxunicode + 1):
            if not 0xD800 <= code < 0xE000 and member.match(chr(code)):
                if found and found[-1][1] == code - 1:
                    found[-1][1] = code
                else:
                    found.append([code, code])
        return "".join(f"\\x{{{low:x}}}-\\x{{{high:x}}}" for low, high in found)

    letters, numbers = ranges("L"), ranges("N")
    inside = public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{letters}{numbers}]")
    return inside.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")


def words_of(text: Column) -> Column:
    """Matches of the split pattern in a non-null text."""
    plain = F.regexp_extract_all(text, F.lit("(?U)" + public_tokenizers.PATTERN), F.lit(0))
    spelled = F.regexp_extract_all(text, F.lit("(?U)" + spelled_out_pattern()), F.lit(0))
    return F.when(text.rlike(r"\p{Cn}"), spelled).otherwise(plain)


def literal(value: object, kind: str) -> Column:
    """A constant of any shape; the optimizer evaluates it once."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), kind)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class Merges:
    """The rank of two tokens written one after the other, for many pairs at once, in an open-addressed table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.asarray([ranks[bytes((value,))] for value in range(256)], np.int32)
        found = {}
        for token, rank in ranks.items():
            for at in range(1, len(token)):
                left, right = ranks.get(token[:at]), ranks.get(token[at:])
                if left is not None and right is not None:
                    found[left << 32 | right] = rank
        self.of_pair = found
        bits = max(4, (4 * len(found)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.pairs = np.full(1 << bits, -1, np.int64)
        self.merged = np.full(1 << bits, NO_MERGE, np.int32)
        pairs, merged = np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), np.int32, len(found))
        slots = self._slots(pairs)
        while len(pairs):
            free = self.pairs[slots] == -1
            first = np.zeros(len(pairs), bool)
            first[np.unique(slots, return_index=True)[1]] = True
            put = free & first
            self.pairs[slots[put]], self.merged[slots[put]] = pairs[put], merged[put]
            pairs, merged, slots = pairs[~put], merged[~put], (slots[~put] + 1) & self.last

    def _slots(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.view(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the merged pairs, ``NO_MERGE`` where there is none."""
        pairs = left.astype(np.int64) << 32 | right
        slots = self._slots(pairs)
        out = np.full(len(pairs), NO_MERGE)
        open = np.arange(len(pairs))
        while len(open):
            held = self.pairs[slots]
            hit = held == pairs[open]
            out[open[hit]] = self.merged[slots[hit]]
            on = ~hit & (held != -1)
            open, slots = open[on], (slots[on] + 1) & self.last
        return out

    def fold(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, their ids) of words of one length, given as a matrix of byte ids, as they come to their end."""
        rows = np.arange(len(words))
        ranks = self(words[:, :-1].ravel(), words[:, 1:].ravel()).reshape(len(words), -1)
        while len(rows):
            n = words.shape[1]
            if n == 1:
                yield rows, words
                return
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            ended = best == NO_MERGE
            if ended.any():
                yield rows[ended], words[ended]
                on = ~ended
                rows, words, ranks, at, best = rows[on], words[on], ranks[on], at[on], best[on]
                if not len(rows):
                    return
            line = np.arange(len(rows))
            words[line, at] = best
            words = _without(words, line, at + 1)
            ranks = _without(ranks, line, at)
            before, after = np.flatnonzero(at > 0), np.flatnonzero(at < n - 2)
            here = at[before]
            ranks[before, here - 1] = self(words[before, here - 1], words[before, here])
            here = at[after]
            ranks[after, here] = self(words[after, here], words[after, here + 1])

    def fold_long(self, word: np.ndarray) -> np.ndarray:
        """Ids of one word: the same steps, the pairs in a heap and the ids in a chain."""
        ids, of_pair = word.tolist(), self.of_pair
        before, after = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
        heap = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < len(ids):
                pair = ids[at], ids[after[at]]
                rank = of_pair.get(pair[0] << 32 | pair[1])
                if rank is not None:
                    heapq.heappush(heap, (rank, at, pair))

        for at in range(len(ids)):
            offer(at)
        while heap:
            rank, at, pair = heapq.heappop(heap)
            right = after[at]
            if right >= len(ids) or (ids[at], ids[right]) != pair:  # one of them was merged meanwhile
                continue
            ids[at], ids[right] = rank, -1
            after[at] = after[right]
            if after[at] < len(ids):
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return np.asarray([id for id in ids if id >= 0], np.int32)

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes): the ids of the words one after the other, and how many each has."""
        data = [word.encode() for word in words]
        tokens = np.fromiter((self.ranks.get(word, -1) for word in data), np.int32, len(data))
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        ends = np.cumsum(sizes)
        starts, lengths = ends - sizes, sizes
        ids = self.byte_ids[np.frombuffer(b"".join(data), np.uint8)]
        sizes = np.where(tokens >= 0, 1, lengths)
        ids[starts[tokens >= 0]] = tokens[tokens >= 0]
        folded = np.flatnonzero((tokens < 0) & (lengths > 1))
        folded = folded[np.argsort(lengths[folded], kind="stable")]
        long = np.searchsorted(lengths[folded], LONG_WORD, "right")
        for at in folded[long:]:
            found = self.fold_long(ids[starts[at] : ends[at]])
            ids[starts[at] : starts[at] + len(found)], sizes[at] = found, len(found)
        cuts = np.flatnonzero(np.diff(lengths[folded[:long]])) + 1
        for same in np.split(folded[:long], cuts):
            if len(same):
                length = np.arange(lengths[same[0]])
                for rows, found in self.fold(ids[starts[same][:, None] + length]):
                    ids[starts[same[rows]][:, None] + np.arange(found.shape[1])] = found
                    sizes[same[rows]] = found.shape[1]
        return ids[_spans(starts, sizes)], sizes


def _without(rows: np.ndarray, line: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The matrix without one place of each row."""
    kept = np.ones(rows.shape, bool)
    kept[line, at] = False
    return rows[kept].reshape(len(rows), rows.shape[1] - 1)


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of every span, one span after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


@functools.lru_cache(maxsize=2)
def merges_of(ranks_path: str) -> Merges:
    """One per Python worker, so that the rank file is read once."""
    return Merges(read_ranks(ranks_path))


class WordMemory:
    """Ids of the distinct words of a block; keeps those of the most frequent for the next block."""

    def __init__(self, merges: Merges, remembered: int):
        self.merges, self.remembered = merges, remembered
        self.known: dict[str, int] = {}
        self.ids, self.starts, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of words one after the other, each distinct one encoded once."""
        numbered = words.dictionary_encode()
        distinct, at = numbered.dictionary.to_pylist(), numbered.indices.to_numpy()
        places = np.fromiter((self.known.get(word, -1) for word in distinct), np.int64, len(distinct))
        fresh = np.flatnonzero(places < 0)
        ids, sizes = self.merges.ids_of([distinct[k] for k in fresh])
        places[fresh] = len(self.starts) + np.arange(len(fresh))
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(sizes) - sizes))
        self.sizes, self.ids = np.concatenate((self.sizes, sizes)), np.concatenate((self.ids, ids))
        of = places[at]
        found = self.ids[_spans(self.starts[of], self.sizes[of])], self.sizes[of]
        self._forget(distinct, places, np.bincount(at, minlength=len(distinct)))
        return found

    def _forget(self, distinct: list[str], places: np.ndarray, times: np.ndarray) -> None:
        kept = np.argsort(-times, kind="stable")[: self.remembered]
        self.known = {distinct[k]: n for n, k in enumerate(kept)}
        starts, self.sizes = self.starts[places[kept]], self.sizes[places[kept]]
        self.ids = self.ids[_spans(starts, self.sizes)]
        self.starts = np.cumsum(self.sizes) - self.sizes


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``BLOCK_WORDS`` words, or of one row; the words are its last column."""
    offsets, start = batch.column(batch.num_columns - 1).offsets.to_numpy(), 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + BLOCK_WORDS, "right")) - 1)
        stop = min(stop, batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def encode(
    docs: DataFrame,
    ranks_path: str,
    text: str = "text",
    out: str = "ids",
    remembered: int = REMEMBERED,
) -> DataFrame:
    """The input with an array of the ids of the whole text."""
    if out.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the input has a column {out}")
    names = [*docs.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordMemory(merges_of(ranks_path), remembered)
        for batch in batches:
            for block in _blocks(batch):
                words = block.column(block.num_columns - 1)
                ids, sizes = memory.encode(words.flatten())
                ends = np.concatenate(([0], np.cumsum(sizes)))
                offsets = words.offsets.to_numpy()
                found = pa.ListArray.from_arrays(
                    pa.array(ends[offsets - offsets[0]], pa.int32()), pa.array(ids.astype(np.int64))
                )
                yield pa.RecordBatch.from_arrays([*block.columns[:-1], found], names=names)

    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    split = docs.withColumn(free_name(names, "words"), words_of(body))
    kinds = StructType(list(docs.schema.fields)).add(out, ArrayType(LongType()))
    return split.mapInArrow(run, kinds)


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """Bytes of an array of ids."""
    tokens = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token.hex()
    pieces = let(literal(tokens, "array<string>"), lambda t: F.transform(ids, lambda i: F.get(t, i)))
    return F.unhex(F.array_join(pieces, ""))


def little_endian(ids: Column, ranks: dict[bytes, int]) -> Column:
    """Ids as little-endian unsigned 32-bit integers."""
    written = [i.to_bytes(4, "little").hex() for i in range(max(ranks.values()) + 1)]
    pieces = let(literal(written, "array<string>"), lambda t: F.transform(ids, lambda i: F.get(t, i)))
    return F.unhex(F.array_join(pieces, ""))


def digests(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes per document."""
    ranks = read_ranks(ranks_path)
    encoded = encode(docs.select("doc_id", "text"), ranks_path, out="_ids")
    return encoded.select(
        "doc_id",
        F.size("_ids").cast("long").alias("n_tokens"),
        F.sha2(little_endian(F.col("_ids"), ranks), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("_ids"), ranks), 256).alias("decoded_sha256"),
    )
