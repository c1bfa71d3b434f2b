"""Near duplicates by consistent weighted sampling over TF-IDF shingles.

A text is the bag of its five-word shingles (lower-cased words between white space; a shorter text is one shingle).
A shingle weighs its count times ``1 + ln((N + 1) / (df + 1)) / ln(N + 1)``, where ``df`` is the exact number of documents with
it. Texts lie in blocks of bounded size; a block sends its distinct shingles, dealt by hash into as many parts as there are
blocks, and gets back the frequencies above 1. So no task holds more than a block or a part, whatever the corpus. Improved
consistent weighted sampling draws 96 samples of each text, each shingle's random numbers coming from its hash; two texts
agree in a sample with the probability of their weighted Jaccard similarity. Four samples make a band; texts that
share a band are compared, and linked if the exact weighted Jaccard similarity is at least 0.8. A pair of that
similarity shares no band with a probability of 3 in a million.

No group is expanded into its pairs:

* texts with the same words are one vertex from the start;
* each band bucket links its members to its lowest vertex; of a vertex's links the one with the best estimate from
  the samples is verified first, then those that do not lie within a component by then;
* buckets whose members still lie in several components are compared across components only, in blocks of bounded size, by
  samples: the members of a bucket's largest component lie in one block each and meet the others there, so a foreign member does not
  bring a large group together with itself. What may be near across components forms families. The texts of a family
  come together in the same way, and pairs are verified where they lie. A task hands on a spanning set of links, never its pairs.

So every pair in a bucket is linked through its component, or verified, or has an estimate below 0.6 (which a pair at
0.8 has with a probability of 1 in a million). The texts of all members of buckets are fetched for verification, once.

Null texts count as empty; texts without words form one class. A class is named by its smallest ``doc_id``; missing ids
come last. Of repeated rows each is a member. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.llm.components import components, extended
from voltide.llm.tables import first_of_each, free_name, row_mark
from voltide.session import stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
SAMPLES = BANDS * ROWS
BLOCK_CHARS = 6_000_000
LEAST_ESTIMATE = 0.6
BLOCK, TEXT_BLOCK = 512, 1024
AT_ONCE = 1 << 17
TABLE_BITS = 16
CODEC = pa.Codec("zstd")
LIGHT = 2

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _STEP
    return values ^ (values >> np.uint64(29))


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def packed(text: str | None) -> bytes:
    """A text on its own in less space, so that it crosses the network and lies on disk like this; null is empty."""
    data = (text or "").encode()
    return len(data).to_bytes(8, "little") + CODEC.compress(data, asbytes=True)


def unpacked(data: bytes) -> str:
    return CODEC.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True).decode()


def shingles(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the distinct shingles, ascending."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    long = min(SHINGLE, len(words))
    n = len(words) - long + 1
    joined = np.full(n, long, np.uint64)
    for k in range(long):
        joined = joined * _MIX + hashes[k : k + n]
    return np.unique(_mixed(joined), return_counts=True)


def identity(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest("\x1f".join(words))


@dataclass
class Weights:
    """Weights of shingles by document frequency; ``hashes`` are ascending, a shingle not among them has frequency 1."""

    total: int
    hashes: np.ndarray
    frequencies: np.ndarray

    @classmethod
    def of(cls, docs: DataFrame, text: str) -> Weights:
        """Of a small corpus, on the driver; ``groups`` looks frequencies up block by block."""
        blocks = blocked(docs.withColumn("_id", F.lit(None).cast("long")), "_id", text)
        total = blocks.count()
        found = shared_frequencies(blocks).toArrow()
        return cls(total, *frequency_table(found))

    def frequencies_of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.ones(len(hashes), np.uint32)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.frequencies[at], 1).astype(np.uint32)

    def __call__(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return weigh(self.total, self.frequencies_of(hashes), counts)


def weigh(total: int, frequencies: np.ndarray, counts: np.ndarray) -> np.ndarray:
    idf = 1 + np.log((total + 1) / (frequencies + 1.0)) / math.log(max(total + 1, 2))
    return idf.astype(np.float32) * counts.astype(np.float32)


def bag_of(text: bytes, frequencies: bytes, total: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, weights) of a packed text with the frequencies kept with it; none are kept if all are 1."""
    hashes, counts = shingles(words_of(unpacked(text)))
    of = np.frombuffer(frequencies, np.uint32) if frequencies else np.ones(len(hashes), np.uint32)
    return hashes, weigh(total, of, counts)


def blocked(docs: DataFrame, id: str, text: str) -> DataFrame:
    """The rows, texts packed, with a row id and a block of bounded size, written once, so that both stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, 0
        for batch in batches:
            of, texts = [], []
            for row_id, value in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                if block is None or held >= BLOCK_CHARS:
                    block, held = row_id, 0
                of.append(block)
                text = value.as_py()
                texts.append(packed(text))
                held += len(text or "")
            yield pa.RecordBatch.from_arrays(
                [pa.array(of, pa.int64()), *batch.columns[:2], pa.array(texts, pa.binary())],
                names=["block", "row_id", "id", "text"],
            )

    read = docs.select(F.monotonically_increasing_id(), F.col(id).cast("long"), F.col(text).cast("string"))
    return stage(read.mapInArrow(run, "block long, row_id long, id long, text binary"), "blocks")


def planes(hashes: np.ndarray) -> bytes:
    """Ascending hashes byte by byte: first all highest bytes, which hardly change and compress well."""
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(">u8").ravel().astype(np.uint64)


_SHARED = "block long, hashes binary, counts binary"


def shared_frequencies(blocks: DataFrame) -> DataFrame:
    """(block, hashes, counts): the document frequencies above 1 of the shingles of each block, in pieces."""
    parts = 1 << max(3, (blocks.select("block").distinct().count() - 1).bit_length())
    shift = np.uint64(65 - parts.bit_length())

    def pieces(block: int, bags: list[np.ndarray]) -> pa.RecordBatch:
        hashes, counts = np.unique(np.concatenate(bags), return_counts=True)
        ends = np.searchsorted((hashes >> shift).astype(np.int64), np.arange(parts + 1))
        rows = [(k, ends[k], ends[k + 1]) for k in range(parts) if ends[k] < ends[k + 1]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _, _ in rows], pa.int64()),
                pa.array([block] * len(rows), pa.int64()),
                pa.array([planes(hashes[i:j]) for _, i, j in rows], pa.binary()),
                pa.array([counts[i:j].astype(np.uint32).tobytes() for _, i, j in rows], pa.binary()),
            ],
            names=["part", "block", "hashes", "counts"],
        )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, bags = None, []
        for batch in batches:
            for block, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if block != last and bags:
                    yield pieces(last, bags)
                    bags = []
                last = block
                bags.append(shingles(words_of(unpacked(value.as_py())))[0])
        if bags:
            yield pieces(last, bags)

    def add_up(table: pa.Table) -> pa.Table:
        hashes, counts = _joined(table)
        found, at = np.unique(hashes, return_inverse=True)
        total = np.bincount(at, counts, len(found)).astype(np.uint32)[at]
        sizes = np.asarray([len(h) // 8 for h in table["hashes"].to_pylist()])
        starts = np.concatenate(([0], np.cumsum(sizes)))
        kept = []
        for k, block in enumerate(table["block"].to_pylist()):
            one = slice(starts[k], starts[k + 1])
            more = total[one] > 1
            if more.any():
                kept.append((block, planes(hashes[one][more]), total[one][more].tobytes()))
        columns = zip(*kept, strict=True) if kept else ((), (), ())
        kinds = (pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["block", "hashes", "counts"])

    sent = blocks.select("block", "text").mapInArrow(send, f"part long, {_SHARED}")
    return sent.groupBy("part").applyInArrow(add_up, _SHARED)


def _joined(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    hashes = [from_planes(piece) for piece in table["hashes"].to_pylist()]
    return np.concatenate(hashes) if hashes else np.empty(0, np.uint64), np.frombuffer(b"".join(table["counts"].to_pylist()), np.uint32)


def frequency_table(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, frequencies) of pieces, ascending; a shingle that came twice has the same frequency in both."""
    hashes, counts = _joined(table)
    found, first = np.unique(hashes, return_index=True)
    return found, counts[first]


class Sampler:
    """Improved consistent weighted sampling; a shingle's numbers are looked up by its hash in three fixed tables.

    A sample's value falls with the shingle's weight, in steps. So the values at weight 1 and at ``LIGHT``, which bounds the
    weight of a shingle that occurs once, are tables too, and only shingles whose least value is not above the least of the
    text's greatest values are computed: a few of each text. All others have a larger value, so the samples are the same.
    """

    def __init__(self) -> None:
        random = np.random.default_rng(20)
        n = 1 << TABLE_BITS
        self.r = random.gamma(2, 1, n).astype(np.float32)
        self.inverse = (1 / self.r).astype(np.float32)
        self.log_c = np.log(random.gamma(2, 1, n)).astype(np.float32)
        self.beta = random.random(n, dtype=np.float32)
        self.turns = random.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.light = np.float32(math.log(LIGHT))
        every = np.arange(n)
        self.greatest, self.least = (self.values(every, np.full(n, log, np.float32))[0] for log in (0, self.light))

    def values(self, at: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, steps) of shingles by their places in the tables and the logarithms of their weights."""
        r, beta = self.r[at], self.beta[at]
        t = np.floor(logs * self.inverse[at] + beta)
        return self.log_c[at] - r * (t - beta + 1), t

    def __call__(self, hashes: np.ndarray, weights: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Samples (text x SAMPLES) of the texts whose shingles lie one after the other, each with at least one."""
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        logs = np.log(weights)
        unbounded = (logs > self.light) | (logs < 0)
        above = np.flatnonzero(logs < 0)
        out = np.empty((len(sizes), SAMPLES), np.uint64)
        for k, turn in enumerate(self.turns):
            at = ((hashes * turn) >> np.uint64(64 - TABLE_BITS)).view(np.int64)
            greatest = self.greatest.take(at)
            greatest[above] = np.inf
            bound = np.repeat(np.minimum.reduceat(greatest, starts), sizes)
            open = np.flatnonzero((self.least.take(at) <= bound) | unbounded)
            values, t = self.values(at[open], logs[open])
            first = np.searchsorted(open, starts)
            lowest = np.repeat(np.minimum.reduceat(values, first), np.diff(first, append=len(open)))
            least = np.flatnonzero(values == lowest)
            taken = least[np.searchsorted(least, first)]
            out[:, k] = _mixed(hashes[open[taken]] + t[taken].astype(np.int64).astype(np.uint64) * _MIX + turn)
        return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key per text and band, with the band mixed in."""
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX, (len(samples), BANDS)).copy()
    by_band = samples.reshape(len(samples), BANDS, ROWS)
    for k in range(ROWS):
        keys = _mixed(keys * _STEP + by_band[:, :, k])
    return keys.view(np.int64)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two (hashes, weights); 1 for two empty texts."""
    if not len(a[0]) and not len(b[0]):
        return 1.0
    _, in_a, in_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = float(np.minimum(a[1][in_a], b[1][in_b]).sum(dtype=np.float64))
    return low / (float(a[1].sum(dtype=np.float64)) + float(b[1].sum(dtype=np.float64)) - low)


_ROWS = (
    "row_id long, id long, d1 long, d2 long, total double, frequencies binary, samples binary, bands array<long>"
)


def sketches(blocks: DataFrame, total: int) -> DataFrame:
    """Identity, weight, frequencies of its shingles, 16 bits of each sample, and band keys of every row."""

    def run(rows: pa.Table, shared: pa.Table) -> pa.Table:
        weights, sampler, out, at = Weights(total, *frequency_table(shared)), Sampler(), [], 0
        row_ids, doc_ids = rows["row_id"].to_pylist(), rows["id"].to_pylist()
        while at < len(row_ids):
            ids, digests, bags, frequencies, held = [], [], [], [], 0
            while at < len(row_ids) and held < AT_ONCE:
                words = words_of(unpacked(rows["text"][at].as_py()))
                ids.append((row_ids[at], doc_ids[at]))
                digests.append(identity(words))
                hashes, counts = shingles(words)
                of = weights.frequencies_of(hashes)
                frequencies.append(of.tobytes() if (of > 1).any() else b"")
                bags.append((hashes, weigh(total, of, counts)))
                held, at = held + len(hashes), at + 1
            out.append(_sketch_batch(ids, digests, bags, frequencies, sampler))
        return pa.Table.from_batches(out)

    shared = stage(shared_frequencies(blocks), "shared-frequencies")
    both = blocks.groupBy("block").cogroup(shared.groupBy("block"))
    return stage(both.applyInArrow(run, _ROWS), "sketches")


def _sketch_batch(ids, digests, bags, frequencies, sampler: Sampler) -> pa.RecordBatch:
    full = [k for k, bag in enumerate(bags) if len(bag[0])]
    samples, bands = [b""] * len(bags), [[] for _ in bags]
    if full:
        drawn = sampler(
            np.concatenate([bags[k][0] for k in full]),
            np.concatenate([bags[k][1] for k in full]),
            np.asarray([len(bags[k][0]) for k in full]),
        )
        keys, short = band_keys(drawn), drawn.astype(np.uint16)
        for k, at in enumerate(full):
            samples[at], bands[at] = short[k].tobytes(), keys[k]
    halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([row_id for row_id, _ in ids], pa.int64()),
            pa.array([doc_id for _, doc_id in ids], pa.int64()),
            pa.array(halves[:, 0], pa.int64()),
            pa.array(halves[:, 1], pa.int64()),
            pa.array([float(w.sum(dtype=np.float64)) for _, w in bags], pa.float64()),
            pa.array(frequencies, pa.binary()),
            pa.array(samples, pa.binary()),
            pa.array(bands, pa.list_(pa.int64())),
        ],
        names=["row_id", "id", "d1", "d2", "total", "frequencies", "samples", "bands"],
    )


def near_enough(total_a, total_b, samples_a: np.ndarray, samples_b: np.ndarray, similarity: float) -> tuple:
    """(estimates, which of them can still reach the similarity); totals bound the similarity from above."""
    estimate = (samples_a == samples_b).mean(axis=-1)
    bound = np.minimum(total_a, total_b) / np.maximum(total_a, total_b)
    least = LEAST_ESTIMATE - (SIMILARITY - similarity)
    return estimate, (estimate >= least) & (bound >= similarity - 1e-6)


def _matrix(column) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint16).reshape(len(column), SAMPLES)


def estimated(pairs: DataFrame, reps: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) that can reach the similarity, with the estimate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, total_a, total_b, samples_a, samples_b = batch.columns
            if not batch.num_rows:
                continue
            estimate, near = near_enough(
                total_a.to_numpy(), total_b.to_numpy(), _matrix(samples_a), _matrix(samples_b), similarity
            )
            out = pa.RecordBatch.from_arrays([a, b, pa.array(estimate, pa.float64())], names=["a", "b", "estimate"])
            yield out.filter(pa.array(near))

    side = reps.select("v", "total", "samples")
    both = pairs.join(side.toDF("a", "total_a", "samples_a"), "a").join(side.toDF("b", "total_b", "samples_b"), "b")
    return both.select("a", "b", "total_a", "total_b", "samples_a", "samples_b").mapInArrow(
        run, "a long, b long, estimate double"
    )


def fetch_texts(blocks: DataFrame, wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """(v, text, frequencies) of the wanted vertices (v), texts packed, from the blocks and the sketches."""
    texts = blocks.select(F.col("row_id").alias("v"), "text").join(wanted, "v", "left_semi")
    return stage(texts.join(rows.select(F.col("row_id").alias("v"), "frequencies"), "v"), "compared-texts")


def verified(pairs: DataFrame, texts: DataFrame, total: int, similarity: float) -> DataFrame:
    """Pairs (a, b) with ``linked``: whether their weighted Jaccard similarity reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, bag_a = None, None
        for batch in batches:
            linked = []
            for a, *sides in zip(batch.column(0).to_pylist(), *batch.columns[2:], strict=True):
                text_a, of_a, text_b, of_b = sides
                if a != last:
                    last, bag_a = a, bag_of(text_a.as_py(), of_a.as_py(), total)
                linked.append(weighted_jaccard(bag_a, bag_of(text_b.as_py(), of_b.as_py(), total)) >= similarity)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"]
            )

    both = pairs.select("a", "b").join(texts.toDF("b", "text_b", "of_b"), "b").join(texts.toDF("a", "text_a", "of_a"), "a")
    compared = both.select("a", "b", "text_a", "of_a", "text_b", "of_b").mapInArrow(run, "a long, b long, linked boolean")
    return stage(compared, "verified")


def in_blocks(rows: DataFrame, group: str, n: str, size: int) -> DataFrame:
    """Rows of a group once for each pair of blocks they take part in.

    A block holds about ``size`` rows; ``half`` tells the two blocks of a pair apart (0: a block with itself).
    """
    blocks = F.ceil(F.col(n) / size).cast("int")
    copies = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(
            F.least(other, F.col("block")).alias("low"),
            F.greatest(other, F.col("block")).alias("high"),
            F.when(other == F.col("block"), 0).when(F.col("block") < other, 1).otherwise(2).alias("half"),
        ),
    )
    return (
        rows.withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("v"), blocks).cast("int")})
        .select(group, "v", "component", F.explode(copies).alias("pair"))
        .select(group, "v", "component", "pair.*")
    )


def facing(rows: DataFrame, group: str, size: int) -> DataFrame:
    """Rows (group, v, component) of groups once for each block in which they meet rows of other components.

    Every member of the group's largest component lies in one block of about ``size`` rows, which all others join; the others
    also meet each other in pairs of blocks. Rows of that component never meet.
    """
    sizes = rows.groupBy(group, "component").agg(F.count(F.lit(1)).alias("rows"))
    largest = F.max(F.struct("rows", "component")).alias("main")
    whole = stage(
        sizes.groupBy(group)
        .agg(largest, F.sum("rows").alias("all"))
        .select(group, F.col("main.component").alias("main"), F.col("main.rows").alias("n_main"), "all"),
        "facing-groups",
    )
    placed = rows.join(whole, group)
    main = F.col("component") == F.col("main")
    n_blocks = F.ceil(F.col("n_main") / size).cast("int")
    high, kinds = F.lit(-1), [group, "v", "component", "low", "high", "half"]
    once = F.pmod(F.xxhash64("v"), n_blocks).cast("int")
    mains = placed.where(main).select(group, "v", "component", (-1 - once).alias("low"), high.alias("high"), F.lit(1).alias("half"))
    others = placed.where(~main).select(group, "v", "component", n_blocks.alias("n_blocks"), (F.col("all") - F.col("n_main")).alias("n"))
    visits = others.select(
        group, "v", "component", F.explode(F.sequence(-F.col("n_blocks"), F.lit(-1))).alias("low"), high.alias("high"), F.lit(2).alias("half")
    )
    return mains.select(*kinds).unionByName(visits.select(*kinds)).unionByName(in_blocks(others, group, "n", size).select(*kinds))


def open_members(members: DataFrame, named: DataFrame) -> DataFrame:
    """(key, v, component) of the buckets that still hold several components."""
    placed = members.select("key", "v").join(named, "v", "left").withColumn("component", F.coalesce("component", "v"))
    split = placed.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    return stage(placed.join(split.filter("least != most").select("key"), "key"), "open-members")


def near_pairs(table: pa.Table, similarity: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(i, others, estimates): members of other components in the facing block that i can reach the similarity with."""
    component, half = table["component"].to_numpy(), table["half"].to_numpy()
    samples, total = _matrix(table["samples"].combine_chunks()), table["total"].to_numpy()
    alone = not half.any()
    left, right = np.flatnonzero(half != 2), np.flatnonzero(half != 1)
    for i in left:
        others = right[component[right] != component[i]]
        if alone:
            others = others[others > i]
        if len(others):
            estimate, near = near_enough(total[i], total[others], samples[i], samples[others], similarity)
            if near.any():
                yield i, others[near], estimate[near]


class Roots:
    """Union of small sets inside one task."""

    def __init__(self) -> None:
        self.of: dict[int, int] = {}

    def root(self, x: int) -> int:
        self.of.setdefault(x, x)
        while self.of[x] != x:
            self.of[x] = self.of[self.of[x]]
            x = self.of[x]
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether the two were apart."""
        x, y = self.root(x), self.root(y)
        self.of[max(x, y)] = min(x, y)
        return x != y


def _link_table(links: list[tuple[int, int]]) -> pa.Table:
    a, b = zip(*links, strict=True) if links else ((), ())
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def families(rows: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that span, per task, the vertices which may be near across components."""

    def run(table: pa.Table) -> pa.Table:
        v, roots, links = table["v"].to_numpy(), Roots(), []
        for i, others, _ in near_pairs(table, similarity):
            links += [(v[i], v[k]) for k in others if roots.join(int(v[i]), int(v[k]))]
        return _link_table(links)

    return rows.groupBy("key", "low", "high").applyInArrow(run, "a long, b long")


def links_across(rows: DataFrame, total: int, similarity: float) -> DataFrame:
    """Links (a, b) between components of a family, verified where the texts lie, best estimate first.

    A pair is left out if links of this task have joined its ends: a task gives fewer links than it has members.
    """

    def run(table: pa.Table) -> pa.Table:
        v, component = table["v"].to_numpy(), table["component"].to_numpy()
        bags: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        roots, links = Roots(), []

        def bag(i: int) -> tuple[np.ndarray, np.ndarray]:
            if i not in bags:
                bags[i] = bag_of(table["text"][i].as_py(), table["frequencies"][i].as_py(), total)
            return bags[i]

        for i, others, estimates in near_pairs(table, similarity):
            for k in others[np.argsort(-estimates, kind="stable")]:
                ends = int(component[i]), int(component[k])
                if roots.root(ends[0]) != roots.root(ends[1]) and weighted_jaccard(bag(i), bag(k)) >= similarity:
                    roots.join(*ends)
                    links.append((v[i], v[k]))
        return _link_table(links)

    return rows.groupBy("family", "low", "high").applyInArrow(run, "a long, b long")


def groups(docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: id, class_id (the smallest id of its class), group_size, kept (one row of each class)."""
    blocks = blocked(docs, id, text)
    total = blocks.count()
    rows = sketches(blocks, total)
    head = F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "row_id")).alias("head")
    classes = stage(
        rows.groupBy("d1", "d2").agg(head).select("d1", "d2", F.col("head.id").alias("id"), F.col("head.row_id").alias("v")),
        "same-words",
    )
    reps = stage(
        rows.select(F.col("row_id").alias("v"), "total", "samples", "bands")
        .filter(F.size("bands") > 0)
        .join(classes.select("v"), "v", "left_semi"),
        "vertices",
    )
    members_of = reps.select("v", F.explode("bands").alias("key"))
    buckets = stage(
        members_of.groupBy("key").agg(F.min("v").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets"
    )
    members = stage(members_of.join(buckets, "key"), "bucket-members")
    star = members.filter("v != first").select(F.col("first").alias("a"), F.col("v").alias("b")).distinct()
    waiting = stage(estimated(star, reps, similarity), "candidates")
    texts = fetch_texts(blocks, members.select("v").distinct(), rows)
    named = None
    first = F.max(F.struct("estimate", (-F.col("a")).alias("a"))).alias("first")
    for chosen in (waiting.groupBy("b").agg(first).select((-F.col("first.a")).alias("a"), "b"), None):
        if chosen is None:  # what the best pairs have not joined; those that failed are compared once more
            chosen = _apart(waiting, named).select("a", "b")
        found = verified(chosen, texts, total, similarity).filter("linked").select("a", "b")
        if named is None:
            named = components(found)
        elif not found.isEmpty():
            named = extended(named, found)
    sketch = reps.select("v", "total", "samples")
    across = facing(open_members(members, named), "key", BLOCK).join(sketch, "v")
    near = stage(families(across, similarity).distinct(), "near-across")
    if not near.isEmpty():
        family = components(near).withColumnRenamed("component", "family")
        placed = family.join(named, "v", "left").select("family", "v", F.coalesce("component", "v").alias("component"))
        placed = stage(placed, "family-members")
        compared = facing(placed, "family", TEXT_BLOCK).join(sketch.join(texts, "v"), "v")
        found = stage(links_across(compared, total, similarity), "links")
        if not found.isEmpty():
            named = extended(named, found)
    placed = stage(
        rows.select("row_id", "id", "d1", "d2")
        .join(classes.select("d1", "d2", "v"), ["d1", "d2"])
        .join(named, "v", "left")
        .select("row_id", "id", "d1", "d2", F.coalesce("component", "v").alias("component")),
        "near-classes",
    )
    heads = stage(placed.groupBy("component").agg(head, F.count(F.lit(1)).alias("group_size")), "near-heads")
    return placed.join(heads, "component").select(
        F.col("id").alias(id),
        F.col("head.id").alias("class_id"),
        "group_size",
        (F.col("row_id") == F.col("head.row_id")).alias("kept"),
        F.struct("d1", "d2").alias("words_id"),
    )


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, all columns as they were."""
    at = [docs.columns.index(id), docs.columns.index(text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = b"".join(identity(words_of(value.as_py())) for value in batch.column(at[1]))
            halves = np.frombuffer(found, "<i8").reshape(-1, 2)
            arrays = [*batch.columns, pa.array(halves[:, 0]), pa.array(halves[:, 1])]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *marks])

    marks = [free_name(docs.columns, "d1"), free_name(docs.columns, "d2")]
    wider = docs.select("*", *(F.lit(0).cast("long").alias(mark) for mark in marks)).schema
    for mark in marks:
        wider[mark].nullable = True
    kept = groups(docs, id, text, similarity).filter("kept").select(id, "words_id.*")
    kept = kept.select(row_mark(F.col(id), F.col("d1"), F.col("d2")).alias("kept_mark"))
    mark = free_name([*docs.columns, *marks], "mark")
    marked = docs.mapInArrow(run, wider).withColumn(mark, row_mark(F.col(id), *(F.col(half) for half in marks)))
    one = first_of_each(marked.join(kept, F.col(mark) == F.col("kept_mark"), "left_semi"), mark)
    return one.drop(mark, *marks)


def _apart(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component."""
    return (
        pairs.join(named.toDF("a", "of_a"), "a", "left")
        .join(named.toDF("b", "of_b"), "b", "left")
        .filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b"))
        .select(*pairs.columns)
    )
