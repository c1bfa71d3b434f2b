"""Token counts that follow edits.

The text of a document is split into pre-tokens; runs of them are the leaves of a segment tree whose nodes hold characters
and tokens below them. An edit (start, removed characters, inserted text) walks down to the leaf a few characters
before its start, re-encodes from there on, and stops at the first old leaf border behind the edit at which the new split
also has a border: from there on the old leaves hold. Only sums on the paths of the touched leaves change. The
few characters before the edit are the boundary context: a match of the split pattern looks at most three
characters past its end. Counts equal those of encoding the edited text as a whole.

A tree is a pair of integer arrays of its document and travels with it as columns, so nothing is shuffled. Edits come as an
array column, ordered, each in the coordinates of the text that the edits before it left; starts and lengths
beyond the text are cut to it, null inserts are empty. ``collect_edits`` makes that column from a table of edits; an
edit's document must fit one row in any case. Null texts count as empty; an empty text has no tokens and one empty leaf.
Repeated rows are edited each on their own; ids may be missing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide.llm.encoding import Encoder, encoder

LEAF = 32
CONTEXT = 4
MEMORY = 300_000
LONGEST_REMEMBERED = 48
SPLIT = regex.compile(public_tokenizers.PATTERN)
MIXED_BLANKS = regex.compile(r" \s|\s |^ | $")
EDIT = "struct<start:int,removed:int,inserted:string>"


class Counter:
    """Tokens of single pre-tokens, remembered up to a bound."""

    def __init__(self, codec: Encoder):
        self.codec, self.known, self.cuts = codec, {}, {}

    def __call__(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = len(self.codec.codec.encode_ordinary(piece))
            if len(piece) <= LONGEST_REMEMBERED:
                if len(self.known) >= MEMORY:
                    self.known.clear()
                self.known[piece] = n
        return n


    def cut(self, text: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
        pieces = SPLIT.findall(text)
        return tuple(map(len, pieces)), tuple(map(self, pieces))


class Leaves(NamedTuple):
    chars: list[int]
    tokens: list[int]


def leaves_of(lengths: list[int], tokens: list[int], per_leaf: int = LEAF) -> Leaves:
    """Sums over runs of ``per_leaf`` pre-tokens."""
    if not lengths:
        return Leaves([], [])
    starts = range(0, len(lengths), per_leaf)
    return Leaves(
        np.add.reduceat(np.asarray(lengths), starts).tolist(), np.add.reduceat(np.asarray(tokens), starts).tolist()
    )


class Tree:
    """Sums of characters and tokens; node k has the children 2k and 2k + 1, leaves start at ``width``."""

    def __init__(self, leaves: Leaves):
        self.n = max(1, len(leaves.chars))
        self.width = 1 << (self.n - 1).bit_length()
        self.chars, self.tokens = (np.zeros(2 * self.width, np.int64) for _ in range(2))
        for sums, values in ((self.chars, leaves.chars), (self.tokens, leaves.tokens)):
            sums[self.width : self.width + len(values)] = values
            at = self.width
            while at > 1:
                sums[at // 2 : at] = sums[at : 2 * at].reshape(-1, 2).sum(axis=1)
                at //= 2

    @classmethod
    def from_nodes(cls, n: int, chars: np.ndarray, tokens: np.ndarray) -> Tree:
        tree = cls.__new__(cls)
        tree.n, tree.width = n, len(chars) // 2
        tree.chars, tree.tokens = chars.astype(np.int64), tokens.astype(np.int64)
        return tree

    def leaf_at(self, position: int) -> tuple[int, int]:
        """(leaf, characters before it) of the leaf that holds a position; the last one for positions behind."""
        position = min(position, int(self.chars[1]) - 1)
        at, before = 1, 0
        while at < self.width:
            at *= 2
            if position - before >= self.chars[at]:
                before += int(self.chars[at])
                at += 1
        return min(at - self.width, self.n - 1), before

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        at = self.width + leaf
        more = chars - self.chars[at], tokens - self.tokens[at]
        while at:
            self.chars[at] += more[0]
            self.tokens[at] += more[1]
            at //= 2

    def leaves(self, first: int, last: int) -> Leaves:
        part = slice(self.width + first, self.width + last)
        return Leaves(self.chars[part].tolist(), self.tokens[part].tolist())


def split(text: str, count: Counter) -> tuple[list[int], list[int]]:
    """Characters and tokens of each pre-token.

    Between two characters that are no blanks a single space always begins a pre-token, so a text can be cut there and
    the cuts be remembered; other texts are split as a whole.
    """
    if MIXED_BLANKS.search(text):
        pieces, known = SPLIT.findall(text), count.known
        return list(map(len, pieces)), [known.get(p) or count(p) for p in pieces]
    words, cuts = text.split(" "), count.cuts
    lengths, tokens = count.cut(words[0])
    lengths, tokens = list(lengths), list(tokens)
    for word in words[1:]:
        found = cuts.get(word)
        if found is None:
            found = count.cut(" " + word)
            if len(word) <= LONGEST_REMEMBERED:
                if len(cuts) >= MEMORY:
                    cuts.clear()
                cuts[word] = found
        lengths += found[0]
        tokens += found[1]
    return lengths, tokens


def build(text: str, count: Counter) -> Tree:
    return Tree(leaves_of(*split(text, count)))


def edit(text: str, tree: Tree, start: int, removed: int, inserted: str, count: Counter) -> tuple[str, Tree, int]:
    """The edited text, its tree and how many characters were encoded again."""
    start = min(max(start, 0), len(text))
    removed = min(max(removed, 0), len(text) - start)
    new = text[:start] + inserted + text[start + removed :]
    if not text or not new:
        return new, build(new, count), len(new)
    more, end = len(inserted) - removed, start + removed
    first, begin = tree.leaf_at(max(0, start - CONTEXT))
    last, border = first, begin  # leaves [first, last) are replaced; border: where leaf ``last`` starts in the old text
    while last < tree.n and border < end:
        border += int(tree.chars[tree.width + last])
        last += 1
    if last == first:
        border += int(tree.chars[tree.width + last])
        last += 1
    lengths, tokens, reached = [], [], begin
    if begin < len(new):
        for found in SPLIT.finditer(new, begin):
            piece = found.group()
            lengths.append(len(piece))
            tokens.append(count(piece))
            reached = found.end()
            while last < tree.n and border + more < reached:
                border += int(tree.chars[tree.width + last])
                last += 1
            if reached == border + more and reached >= start + len(inserted) and last < tree.n:
                break
        else:
            last = tree.n
    else:
        last = tree.n
    places = last - first
    if len(lengths) <= 4 * LEAF * places:
        per_leaf = max(1, -(-len(lengths) // places))
        fresh = leaves_of(lengths, tokens, per_leaf)
        for k in range(places):
            filled = k < len(fresh.chars)
            tree.put(first + k, fresh.chars[k] if filled else 0, fresh.tokens[k] if filled else 0)
    else:
        head, fresh, tail = tree.leaves(0, first), leaves_of(lengths, tokens), tree.leaves(last, tree.n)
        tree = Tree(Leaves(head.chars + fresh.chars + tail.chars, head.tokens + fresh.tokens + tail.tokens))
    return new, tree, reached - begin


TREE = "n_leaves int, tree_chars array<long>, tree_tokens array<long>"


def _columns(trees: list[Tree]) -> list[pa.Array]:
    return [
        pa.array([t.n for t in trees], pa.int32()),
        pa.array([t.chars for t in trees], pa.list_(pa.int64())),
        pa.array([t.tokens for t in trees], pa.list_(pa.int64())),
    ]


def plant(docs: DataFrame, ranks_path: str) -> DataFrame:
    """The documents (doc_id, text, edits if there) with their trees and ``n_tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(encoder(ranks_path))
        for batch in batches:
            trees = [build(text.as_py(), count) for text in batch.column("text")]
            total = pa.array([int(t.tokens[1]) for t in trees], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *_columns(trees), total],
                names=[*batch.schema.names, "n_leaves", "tree_chars", "tree_tokens", "n_tokens"],
            )

    wanted = [c for c in ("doc_id", "edits") if c in docs.columns]
    read = docs.select(*wanted, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in read.schema.fields)
    return read.mapInArrow(run, f"{kinds}, {TREE}, n_tokens long")


def apply_edits(planted: DataFrame, ranks_path: str) -> DataFrame:
    """Planted documents after their edits: new text, tree, ``n_tokens_edited`` and ``n_chars_encoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(encoder(ranks_path))
        for batch in batches:
            texts, trees, again = [], [], []
            for at in range(batch.num_rows):
                text = batch.column("text")[at].as_py()
                nodes = [np.asarray(batch.column(c)[at].values) for c in ("tree_chars", "tree_tokens")]
                tree, encoded = Tree.from_nodes(batch.column("n_leaves")[at].as_py(), *nodes), 0
                for change in batch.column("edits")[at].as_py() or []:
                    if change:
                        where, less, more = change["start"] or 0, change["removed"] or 0, change["inserted"] or ""
                        text, tree, n = edit(text, tree, where, less, more, count)
                        encoded += n
                texts.append(text)
                trees.append(tree)
                again.append(encoded)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(texts, pa.string()),
                    *_columns(trees),
                    batch.column("n_tokens"),
                    pa.array([int(t.tokens[1]) for t in trees], pa.int64()),
                    pa.array(again, pa.int64()),
                ],
                names=["doc_id", "text", "n_leaves", "tree_chars", "tree_tokens", "n_tokens", "n_tokens_edited"]
                + ["n_chars_encoded"],
            )

    id_kind = planted.schema["doc_id"].dataType.simpleString()
    read = planted.select("doc_id", "text", "edits", "n_leaves", "tree_chars", "tree_tokens", "n_tokens")
    return read.mapInArrow(
        run, f"doc_id {id_kind}, text string, {TREE}, n_tokens long, n_tokens_edited long, n_chars_encoded long"
    )


def collect_edits(edits: DataFrame) -> DataFrame:
    """(doc_id, edits) from rows (doc_id, turn, start, removed, inserted)."""
    row = F.struct("turn", "start", "removed", "inserted")
    return edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(row)).alias("rows")).select(
        "doc_id", F.transform("rows", lambda e: e.dropFields("turn")).cast(f"array<{EDIT}>").alias("edits")
    )


def drawn_edits(id: Column, text: Column, n: int = 4) -> Column:
    """``n`` edits anywhere in a text, fixed by its id: some remove, some insert a part of the text, some do both."""
    size = F.length(text)

    def draw(turn: int, what: str, below: Column) -> Column:
        return F.pmod(F.xxhash64(id, F.lit(turn), F.lit(what)), below.cast("long")).cast("int")

    made = [
        F.struct(
            draw(k, "start", size + 1).alias("start"),
            draw(k, "removed", F.lit(40)).alias("removed"),
            F.substring(text, draw(k, "from", size + 1) + 1, draw(k, "long", F.lit(30))).alias("inserted"),
        )
        for k in range(n)
    ]
    return F.array(*made).cast(f"array<{EDIT}>")
