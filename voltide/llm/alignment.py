"""Alignment of two tokenizers' tokens, and how usual each linked pair of ids is in the corpus.

A text, with a space before it, is encoded by a byte-level BPE (A) and by a piece model with byte fallback (B, which adds that
space itself). The places where a token of A and one of B both end cut the text into groups; tokens of a group
are linked. Most tokens agree one to one, so the two arrays of ends are equal along a diagonal: at the current
shift between the indexes, slices of doubling length are compared, which jumps over a stretch of equal ends in logarithmic
many comparisons, and halving lengths find where it stops. There the tokens up to the next common end form an irregular group,
found by advancing whichever side is behind; it sets the new shift.

A pair of ids counts the documents in which it is linked. Each text leaves its distinct pairs and how often they are
linked in a staged table. Tasks count the pairs of many documents before they are shuffled. The most frequent pairs (at most
``REMEMBERED``, so that the table sent to the tasks has a fixed bound) are looked up where the document lies; all other pairs
are joined with their counts as rows. These are rare ones, so no key of that join is hot.

Null and empty texts have no tokens, nor have texts whose joined tokens differ from the text (the piece model
reads U+2581 as a space): their numbers are 0 and their digest is the empty string. Strings of special tokens are plain text. Repeated
rows are aligned one by one and each counts as a document. Null ids pass through. An empty table gives an empty result. Only id and text are read, so
other columns cannot clash. One text's tokens are held in memory by one task.
"""

from __future__ import annotations

import functools
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltide.llm.encoding import tokenizer_file
from voltide.session import stage

SPACE = "▁"
REMEMBERED, SHARES = 1 << 18, 64
PAIRS_AT_ONCE = 1 << 20
TOKENS_AT_ONCE = 1 << 15
CROSS_LISTED = 16
DIGITS, FIRST_STEP, PAIR_BITS = 6, 4, 32
MEASURES = ("n_a", "n_b", "n_groups", "n_links")


Tokens = tuple[np.ndarray, np.ndarray] | None
NOTHING = (0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))


class Pieces:
    """The piece model: ids of a text, and the bytes of an id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]
        self.size = len(self.bytes)

    def _bytes(self, id: int) -> bytes:
        piece = self.model.id_to_piece(id)
        return bytes((int(piece[3:5], 16),)) if self.model.is_byte(id) else piece.replace(SPACE, " ").encode()


class Aligner:
    """Both tokenizers of one worker, and the alignment of their tokens of a text."""

    def __init__(self, json_path: str, ranks_path: str, pieces_path: str):
        self.a, self.b = tokenizer_file(json_path, ranks_path, plain=True), Pieces(pieces_path)
        known = self.a.token_bytes()
        self.a_bytes = [known.get(i, b"") for i in range(max(known) + 1)]
        if len(self.a_bytes) * self.b.size > 1 << PAIR_BITS:
            raise ValueError("pairs of ids do not fit in 32 bits")
        self.a_lengths = np.array([len(token) for token in self.a_bytes], dtype=np.int64)
        self.b_lengths = np.array([len(token) for token in self.b.bytes], dtype=np.int64)
        numbers = [str(i).encode().rjust(DIGITS, b"\0") for i in range(max(len(self.a_bytes), self.b.size))]
        self.digits = np.frombuffer(b"".join(numbers), dtype=np.uint8).reshape(-1, DIGITS)

    def tokens(self, text: str | None) -> Tokens:
        """Ids by A and B, or None where there are none."""
        if not text:
            return None
        whole = " " + text
        a = np.frombuffer(self.a.encode(whole), dtype="<u4")
        b = np.array(self.b.model.encode(text), dtype=np.uint32)
        data = whole.encode()
        if b"".join(map(self.b.bytes.__getitem__, b.tolist())) != data or self.a_lengths[a].sum() != len(data):
            return None  # byte-level ids of the whole length are those bytes
        return a, b

    def align(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int, str, np.ndarray, np.ndarray]]:
        """For each of some texts: groups, links, digest of the groups, and the distinct pairs of ids with their links.

        A pair is the id of A times the size of B, plus the id of B.
        """
        found, a_base, b_base = [], 0, 0
        for a, b in texts:
            ends = np.cumsum(self.a_lengths[a]).tolist(), np.cumsum(self.b_lengths[b]).tolist()
            part = np.array(list(spans(*ends)), dtype=np.int64)
            found.append(part + (a_base, b_base, 0, 0))
            a_base, b_base = a_base + len(a), b_base + len(b)
        part = np.concatenate(found)
        text_of = np.repeat(np.arange(len(texts)), [len(p) for p in found])
        a, b = (np.concatenate(side) for side in zip(*texts, strict=True))
        shown, cuts = self.shown(a, b, part, np.cumsum([len(x) + len(y) for x, y in texts]))
        keys, times = self.links(a, b, part, text_of)
        bounds = np.searchsorted(keys, np.arange(len(texts) + 1) << PAIR_BITS)
        groups = np.bincount(text_of, np.where(part[:, 3], 1, part[:, 2]), len(texts)).astype(np.int64)
        for text, n_groups in enumerate(groups.tolist()):
            begin, end = (0 if text == 0 else cuts[text - 1]), cuts[text] - 1
            here = slice(bounds[text], bounds[text + 1])
            pairs, n = keys[here] & ((1 << PAIR_BITS) - 1), times[here]
            yield n_groups, int(n.sum()), hashlib.sha256(shown[begin:end]).hexdigest(), pairs, n

    def shown(self, a: np.ndarray, b: np.ndarray, part: np.ndarray, texts: np.ndarray) -> tuple[memoryview, list[int]]:
        """All groups as text, every id in decimal with the sign that follows it, and where each input text ends."""
        inner = part[part[:, 3] > 0]
        a_last, b_last = np.ones(len(a), bool), np.ones(len(b), bool)
        a_last[stretches(inner[:, 0], inner[:, 2] - 1)] = False
        b_last[stretches(inner[:, 1], inner[:, 3] - 1)] = False
        a_cuts, b_cuts = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1
        # a token of A stands behind the B tokens of earlier groups, one of B also behind the A tokens of its own group
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        signs = np.empty((len(a) + len(b), DIGITS + 1), dtype=np.uint8)
        a_at = np.arange(len(a)) + np.concatenate([[0], b_cuts])[a_group]
        b_at = np.arange(len(b)) + a_cuts[b_group]
        signs[a_at, :DIGITS], signs[a_at, DIGITS] = self.digits[a], np.where(a_last, ord("|"), ord(","))
        signs[b_at, :DIGITS], signs[b_at, DIGITS] = self.digits[b], np.where(b_last, ord(";"), ord(","))
        used = signs > 0
        return memoryview(signs[used]), np.cumsum(used.sum(axis=1))[texts - 1].tolist()

    def links(self, a: np.ndarray, b: np.ndarray, part: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs in order, with the number of the text in the bits above the pair, and how often each is linked."""
        size = self.b.size
        wide = part[:, 2] * part[:, 3] > CROSS_LISTED
        extra: Counter[int] = Counter()
        for (i, j, n, m), text in zip(part[wide].tolist(), text_of[wide].tolist(), strict=True):
            rights = Counter(b[j : j + m].tolist())  # equal ids of a wide group are counted, not listed
            for x, many in Counter(a[i : i + n].tolist()).items():
                for y, more in rights.items():
                    extra[(text << PAIR_BITS) + x * size + y] += many * more
        i, j, n, m = part[~wide].T
        count = np.where(m, n * m, n)
        step, wrap = stretches(np.zeros(len(count), np.int64), count), np.repeat(m, count)
        run, wrap = wrap == 0, np.maximum(wrap, 1)
        left = np.repeat(i, count) + np.where(run, step, step // wrap)
        right = np.repeat(j, count) + np.where(run, step, step % wrap)
        text = np.repeat(text_of[~wide] << PAIR_BITS, count)
        keys, times = np.unique(text + a[left].astype(np.int64) * size + b[right], return_counts=True)
        if extra:
            more = np.fromiter(extra.values(), np.int64)
            keys, times = summed(np.concatenate([keys, np.fromiter(extra.keys(), np.int64)]), np.concatenate([times, more]))
        return keys, times


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(values, starts)


def stretches(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length says."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def portions(texts: Iterator[Tokens]) -> Iterator[list[Tokens]]:
    """The tokens of consecutive texts, put together until they hold ``TOKENS_AT_ONCE``."""
    part, held = [], 0
    for tokens in texts:
        part.append(tokens)
        held += len(tokens[0]) if tokens else 0
        if held >= TOKENS_AT_ONCE:
            yield part
            part, held = [], 0
    if part:
        yield part


def spans(a: list[int], b: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """Stretches (i, j, n, 0) of n groups of one token each, and irregular groups (i, j, n, m), from two lists of ends.

    Both lists ascend strictly and finish at the same end.
    """
    i, shift, total = 0, 0, len(a)
    while i < total:
        begin, step = i, FIRST_STEP
        while i + step <= total and a[i : i + step] == b[i + shift : i + shift + step]:
            i += step
            step *= 2
        while step > 1:
            step //= 2
            if i + step <= total and a[i : i + step] == b[i + shift : i + shift + step]:
                i += step
        if i > begin:
            yield begin, begin + shift, i - begin, 0
        if i < total:
            begin, j = i, i + shift
            start, x, y = j, a[i], b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            i, j = i + 1, j + 1
            yield begin, start, i - begin, j - start
            shift = j - i


@functools.lru_cache(maxsize=1)
def aligner(json_path: str, ranks_path: str, pieces_path: str) -> Aligner:
    return Aligner(json_path, ranks_path, pieces_path)


def aligned(docs: DataFrame, json_path: str, ranks_path: str, pieces_path: str, id: str, text: str) -> DataFrame:
    """(row, id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every document; the arrays as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(json_path, ranks_path, pieces_path)
        for batch in batches:
            made = []
            for part in portions(tool.tokens(body) for body in batch.column(2).to_pylist()):
                alignments = tool.align([tokens for tokens in part if tokens]) if any(part) else iter(())
                made += [(len(t[0]), len(t[1]), *next(alignments)) if t else NOTHING for t in part]
            *numbers, digests, pairs, times = zip(*made, strict=True) if made else [[]] * 7
            pairs, times = ([array.astype("<u4").tobytes() for array in arrays] for arrays in (pairs, times))
            columns = [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in numbers)]
            columns += [pa.array(digests, pa.string()), pa.array(pairs, pa.binary()), pa.array(times, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", *MEASURES, "groups_sha256", "pairs", "times"])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.col(text).cast("string").alias("body")
    )
    kind = docs.schema[id].dataType.simpleString()
    made = ", ".join(f"{name} long" for name in MEASURES)
    return rows.mapInArrow(run, f"row long, id {kind}, {made}, groups_sha256 string, pairs binary, times binary")


def pair_counts(table: DataFrame) -> DataFrame:
    """(pair, docs): in how many documents each pair is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pair", "docs"])

        keys, n = np.empty(0, np.int64), np.empty(0, np.int64)
        fresh, held = [], 0
        for batch in batches:
            for data in batch.column(0).to_pylist():
                fresh.append(np.frombuffer(data, dtype="<u4").astype(np.int64))
                held += len(fresh[-1])
                if held >= PAIRS_AT_ONCE:
                    keys, n = summed(np.concatenate([keys, *fresh]), np.concatenate([n, np.ones(held, np.int64)]))
                    fresh, held = [], 0
                    if len(keys) >= PAIRS_AT_ONCE:
                        yield out()
                        keys, n = np.empty(0, np.int64), np.empty(0, np.int64)
        keys, n = summed(np.concatenate([keys, *fresh]), np.concatenate([n, np.ones(held, np.int64)]))
        yield out()

    tasks = table.select("pairs").mapInArrow(run, "pair long, docs long")
    return tasks.groupBy("pair").agg(F.sum("docs").alias("docs"))


def with_best(counts: DataFrame, b_size: int) -> DataFrame:
    """(pair, docs, best): whether the count is the highest of the pair's A id; one row per A id is joined."""
    a = F.floor(F.col("pair") / b_size)
    tops = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("top"))
    return counts.join(tops, a == F.col("a")).select("pair", "docs", (F.col("docs") == F.col("top")).alias("best"))


def frequent(counts: DataFrame, remembered: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent pairs, the same number from each of ``SHARES`` shares of the pairs, in order of the pair."""
    share = F.pmod(F.xxhash64("pair"), F.lit(SHARES))
    turn = F.row_number().over(Window.partitionBy("share").orderBy(F.desc("docs"), "pair"))
    ranked = counts.withColumn("share", share).withColumn("turn", turn)
    top = ranked.filter(F.col("turn") <= remembered // SHARES).select("pair", "docs", "best").toArrow()
    if not top.num_rows:  # a pair that no document holds
        return np.zeros(1, np.uint32), np.zeros(1, np.int64), np.zeros(1, bool)
    pairs = top["pair"].to_numpy()
    order = np.argsort(pairs)
    best = np.array(top["best"].to_pylist(), dtype=bool)
    return pairs[order].astype(np.uint32), top["docs"].to_numpy()[order], best[order]


def link_sums(table: DataFrame, counts: DataFrame, remembered: int) -> DataFrame:
    """(row, n_best, count_sum) of every document with links."""
    shared = table.sparkSession.sparkContext.broadcast(frequent(counts, remembered))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs, best = shared.value
        for batch in batches:
            rows, keys, times, bests, sums = [], [], [], [], []
            columns = (batch.column(i).to_pylist() for i in range(3))
            for row, data, counted in zip(*columns, strict=True):
                pairs, n = np.frombuffer(data, dtype="<u4"), np.frombuffer(counted, dtype="<u4").astype(np.int64)
                if not len(pairs):
                    continue
                at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
                hit = known[at] == pairs
                at, rest = at[hit], ~hit
                extra = int(rest.sum())
                rows.append(np.full(extra + 1, row, dtype=np.int64))
                keys.append(np.concatenate([[-1], pairs[rest].astype(np.int64)]))
                times.append(np.concatenate([[0], n[rest]]))
                none = np.zeros(extra, dtype=np.int64)
                bests.append(np.concatenate([[n[hit][best[at]].sum()], none]))
                sums.append(np.concatenate([[(n[hit] * docs[at]).sum()], none]))
            if rows:
                made = [pa.array(np.concatenate(part).astype(np.int64)) for part in (rows, keys, times, bests, sums)]
                yield pa.RecordBatch.from_arrays(made, ["row", "key", "times", "n_best", "count_sum"])

    found = table.select("row", "pairs", "times").mapInArrow(
        run, "row long, key long, times long, n_best long, count_sum long"
    )
    joined = found.join(counts, F.col("key") == F.col("pair"), "left")
    more_best = F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))
    more_sum = F.coalesce(F.col("times") * F.col("docs"), F.lit(0))
    return joined.groupBy("row").agg(
        F.sum(F.col("n_best") + more_best).alias("n_best"), F.sum(F.col("count_sum") + more_sum).alias("count_sum")
    )


def align_documents(
    docs: DataFrame,
    json_path: str,
    ranks_path: str,
    pieces_path: str,
    id: str = "doc_id",
    text: str = "text",
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``ranks_path`` holds the vocabulary of ``json_path`` as ranks.
    """
    table = stage(aligned(docs, json_path, ranks_path, pieces_path, id, text), "aligned-documents")
    counts = stage(with_best(stage(pair_counts(table), "pair-counts"), Pieces(pieces_path).size), "pair-ranks")
    sums = link_sums(table, counts, remembered).withColumnRenamed("row", "sum_row")
    zero = F.lit(0).cast("long")
    return table.join(sums, F.col("row") == F.col("sum_row"), "left").select(
        F.col("id").alias(id),
        *MEASURES,
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
