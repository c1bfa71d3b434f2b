"""Exact duplicates by deterministic block naming.

A normalised text is cut into fixed-size byte blocks. The distinct blocks of the corpus are sorted and numbered, so every
block becomes an integer name; adjacent names are then paired, the distinct pairs are sorted and numbered again, and so on
until one name is left of each document. Texts are equal if and only if they finish on the same level with the same name.

Block text crosses the network once, to find the distinct blocks; map-side combining sends each block once per task,
so a text that a third of the rows share costs no more than a unique one. Occurrences are matched to names by a
128-bit fingerprint. The distinct blocks show whether a fingerprint holds two contents; then all fingerprints are taken
again with the next seed, so a collision costs time and never joins two texts. All later levels move integers only.
Tables that several steps read are written to the shared folder; joins with frequent names are split by adaptive execution.

Null texts count as empty, empty texts are equal to each other. A missing ``doc_id`` sorts behind all others. Of repeated
rows with the same ``doc_id`` and equal text exactly one is kept. An empty table gives an empty result. Only ``id`` and
``text`` are read; other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide.llm.tables import first_of_each, free_name, row_mark
from voltide.session import stage

BLOCK_BYTES = 8192
SEEDS = 16
NO_NAME = -1


def normalised(text: Column) -> Column:
    """Every run of space and the controls 9 to 13 as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def text_digest(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def blocks_of(text: Column, block_bytes: int) -> Column:
    """Blocks of the normalised text; the empty text is one empty block."""
    data = normalised(text).cast("binary")
    last = ((F.greatest(F.octet_length(data), F.lit(1)) - 1) / block_bytes).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda at: F.substring(data, at * block_bytes + 1, F.lit(block_bytes)),
    )


def fingerprint(block: Column, seed: int) -> Column:
    return F.struct(
        F.xxhash64(block, F.lit(2 * seed)).alias("h1"), F.xxhash64(F.lit(2 * seed + 1), block).alias("h2")
    )


def numbered(distinct: DataFrame, keys: list[str], tag: str) -> DataFrame:
    """Sort distinct keys over all partitions and give each its integer name; written once, so names stay."""
    return stage(
        distinct.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("name", F.monotonically_increasing_id()),
        tag,
    )


def _block_names(docs: DataFrame, text: str, block_bytes: int) -> tuple[DataFrame, int]:
    """Names of the distinct blocks by fingerprint, and the seed under which no two blocks share one."""
    for seed in range(SEEDS):
        blocks = docs.select(F.explode(blocks_of(F.col(text), block_bytes)).alias("block"))
        found = fingerprint(F.col("block"), seed)
        distinct = blocks.select(found["h1"].alias("h1"), found["h2"].alias("h2"), "block").distinct()
        contents = distinct.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("contents"))
        names = numbered(contents, ["h1", "h2"], "block-names")
        if names.filter("contents > 1").isEmpty():
            return names.drop("contents"), seed
    raise ValueError("block fingerprints collide under every seed")


def identities(docs: DataFrame, id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES):
    """(rows, names): the staged rows (row_id, id, text_sha256) and each row's identity (row_id, level, name)."""
    names, seed = _block_names(docs, text, block_bytes)
    prints = F.transform(blocks_of(F.col(text), block_bytes), lambda block: fingerprint(block, seed))
    rows = stage(
        docs.select(
            F.monotonically_increasing_id().alias("row_id"),
            F.col(id).alias("id"),
            text_digest(F.col(text)).alias("text_sha256"),
            prints.alias("prints"),
        ),
        "block-prints",
    )
    at_level = stage(
        rows.select("row_id", F.size("prints").alias("n"), F.posexplode("prints").alias("at", "print"))
        .select("row_id", "n", "at", F.col("print.h1").alias("h1"), F.col("print.h2").alias("h2"))
        .join(names, ["h1", "h2"])
        .select("row_id", "n", "at", "name"),
        "names",
    )
    done, level = [], 0
    while True:
        done.append(at_level.filter("n = 1").select("row_id", F.lit(level).alias("level"), "name"))
        rest = at_level.filter("n > 1")
        if rest.isEmpty():
            break
        half = F.floor(F.col("at") / 2)
        pairs = stage(
            rest.groupBy("row_id", half.alias("at"), F.ceil(F.col("n") / 2).cast("int").alias("n")).agg(
                F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(NO_NAME)).alias("right"),
            ),
            "name-pairs",
        )
        level += 1
        names = numbered(pairs.select("left", "right").distinct(), ["left", "right"], "pair-names")
        at_level = stage(pairs.join(names, ["left", "right"]).select("row_id", "n", "at", "name"), "names")
    identity = done[0]
    for more in done[1:]:
        identity = identity.unionByName(more)
    return rows.drop("prints"), identity


def groups(docs: DataFrame, id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    rows, identity = identities(docs, id, text, block_bytes)
    members = stage(identity.join(rows, "row_id"), "named-documents")
    first = F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "row_id"))
    heads = stage(
        members.groupBy("level", "name").agg(first.alias("head"), F.count(F.lit(1)).alias("group_size")), "groups"
    )
    return members.join(heads, ["level", "name"]).select(
        F.col("id").alias(id),
        F.col("head.id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("head.row_id")).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without the copies, all columns as they were."""
    mark = free_name(docs.columns, "mark")
    kept = groups(docs, id, text, block_bytes).filter("kept")
    kept = kept.select(row_mark(F.col(id), F.col("text_sha256")).alias("kept_mark"))
    marked = docs.withColumn(mark, row_mark(F.col(id), text_digest(F.col(text))))
    return first_of_each(marked.join(kept, F.col(mark) == F.col("kept_mark"), "left_semi"), mark).drop(mark)
