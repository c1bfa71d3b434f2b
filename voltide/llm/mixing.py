"""Mixing sources to target weights with hash-threshold histograms.

Every source gets a budget of words: the weights, given to the sources in code point order (a missing source last) and
repeated as needed, share ``share`` times all words; no source gets more than ``limit`` times its own words, and what is over
is shared again by weight until no source is above that. A budget of ``k`` whole passes and a rest takes every document of
the source ``k`` times, and once more those whose draw, a 60-bit hash of seed, id and text, lies below the source's threshold.
The thresholds of a smaller budget are smaller, so what it takes is part of what a larger one takes.

A threshold is found without sorting documents: words are summed by source and hash bucket, running sums over the at
most 1,024 buckets of a source show the bucket in which the budget ends, and only the rows of that bucket are summed again by
the next ten bits, until it holds one document. That one is taken if this brings the source nearer to its budget, so
a source misses its budget by at most half a document. A frequent source is spread over its buckets and summed before it is
shuffled.

A null text has no words, a null id or source is a value like any other. Rows that agree in id and text have one
draw and are taken together, so repeated rows are mixed alike; sources without words take nothing. An empty table gives an
empty result. ``mixed`` keeps all columns and refuses names that the input has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltide.llm.tables import free_name, positions
from voltide.session import stage

WORD = "[^\\x20\\x09-\\x0D]+"
DRAW_BITS, BUCKET_BITS = 60, 10
WEIGHTS, SHARE, LIMIT = (3, 1, 2), 1.5, 2
SEED = "mix"


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def draw(id: Column, text: Column, seed: str = SEED) -> Column:
    """A number below 2^60, the same in every run."""
    parts = (F.coalesce(part.cast("string"), F.lit("")) for part in (id, text))
    digest = F.md5(F.concat_ws(":", F.lit(seed), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame, id: str, text: str, source: str, seed: str = SEED) -> DataFrame:
    """(id, source, size, draw) of every document; the only step that reads texts."""
    return docs.select(
        F.col(id).alias("id"),
        F.col(source).cast("string").alias("source"),
        words(F.col(text)).alias("size"),
        draw(F.col(id), F.col(text), seed).alias("draw"),
    )


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, target) from rows of (source, size)."""
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = positions(totals, [F.col("source").isNull(), F.col("source")], "sources")
    turn = (F.col("position") % len(weights)).cast("int")
    sources = stage(
        placed.select(
            "source",
            "source_size",
            F.get(F.array(*(F.lit(float(w)) for w in weights)), turn).alias("weight"),
            (F.col("source_size") * float(limit)).alias("cap"),
        ),
        "weighted-sources",
    )
    whole = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    budget, free, capped, above = share * (whole["size"] or 0), whole["weight"] or 0.0, 0.0, 0
    while free:
        level = (budget - capped) / free
        over = F.col("cap") < F.col("weight") * level
        state = sources.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)).alias("capped"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("free"),
            F.count_if(over).alias("above"),
        ).first()
        if state["above"] == above:
            break
        capped, free, above = state["capped"], state["free"], state["above"]
    target = F.least(F.col("cap"), F.col("weight") * level) if free else F.col("cap")
    return sources.select("source", "source_size", target.alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """The budgets with ``passes``, the whole passes over a source, and ``below``, the limit of draws that are taken once more.

    ``rows`` holds (source, size, draw), ``budgets`` what ``targets`` gives.
    """
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = stage(
        budgets.withColumn("passes", passes.cast("long")).withColumn(
            "goal", F.col("target") - F.col("passes") * F.col("source_size")
        ),
        "budgets",
    )
    ends = plan.filter("goal > 0").select("source", "goal", F.lit(0).cast("long").alias("before"))
    inside = rows.filter("size > 0").select("source", "size", "draw")
    for shift in range(DRAW_BITS - BUCKET_BITS, -1, -BUCKET_BITS):
        bucket = F.shiftright("draw", shift)
        sums = inside.groupBy("source", bucket.alias("bucket")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")
        )
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        goals = ends.select("source", "goal", "before").alias("e")
        reached = sums.withColumn("upto", upto).alias("s").join(goals, F.col("s.source").eqNullSafe(F.col("e.source")))
        start = F.col("before") + F.col("upto") - F.col("words")
        ends = stage(
            reached.filter((start <= F.col("goal")) & (F.col("goal") < start + F.col("words"))).select(
                "s.source", "goal", start.alias("before"), "bucket", "words", "rows"
            ),
            "boundary-buckets",
        )
        if shift == 0 or ends.filter("rows > 1").isEmpty():
            break
        same = F.col("r.source").eqNullSafe(F.col("e.source")) & (F.shiftright("r.draw", shift) == F.col("e.bucket"))
        inside = stage(
            inside.alias("r").join(ends.alias("e"), same, "left_semi").select("source", "size", "draw"), "boundary-rows"
        )
    nearer = F.col("before") + F.col("words") - F.col("goal") < F.col("goal") - F.col("before")
    below = F.shiftleft(F.col("bucket") + F.when(nearer, F.lit(1)).otherwise(F.lit(0)), shift)
    found = ends.select(F.col("source").alias("end_source"), below.alias("below"))
    return plan.join(found, F.col("source").eqNullSafe(F.col("end_source")), "left").select(
        "source", "source_size", "target", "passes", F.coalesce("below", F.lit(0).cast("long")).alias("below")
    )


def repeats(draw: Column) -> Column:
    """How often a document is taken, beside the columns of ``thresholds``."""
    return F.col("passes") + F.when(draw < F.col("below"), F.lit(1)).otherwise(F.lit(0))


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    limit: int = LIMIT,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: id, size, source_size, target, taken."""
    rows = stage(sized(docs, id, text, source, seed), "sized-documents")
    plan = stage(thresholds(rows, targets(rows, weights, share, limit)), "mix")
    joined = rows.withColumnRenamed("source", "of").join(plan, F.col("of").eqNullSafe(F.col("source")))
    return joined.select(
        F.col("id").alias(id),
        "size",
        "source_size",
        "target",
        (F.col("size") * repeats(F.col("draw"))).alias("taken"),
    )


def mixed(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    limit: int = LIMIT,
    seed: str = SEED,
    copy: str = "copy",
) -> DataFrame:
    """The documents of the mix, each as often as it is taken, numbered from 1 in ``copy``.

    The thresholds are joined to the documents, which are filtered where they are.
    """
    if copy.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the input has a column {copy}")
    rows = stage(sized(docs, id, text, source, seed), "sized-documents")
    plan = stage(thresholds(rows, targets(rows, weights, share, limit)), "mix")
    mark, times = free_name(docs.columns, "mix_source"), free_name(docs.columns, "mix_times")
    plan = plan.select(F.col("source").alias(mark), F.struct("passes", "below").alias(times))
    joined = docs.join(plan, F.col(source).cast("string").eqNullSafe(F.col(mark)))
    once = F.when(draw(F.col(id), F.col(text), seed) < F.col(times)["below"], F.lit(1)).otherwise(F.lit(0))
    joined = joined.withColumn(times, (F.col(times)["passes"] + once).cast("int")).filter(F.col(times) > 0)
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).drop(mark, times)
