"""Quality rules as one projection.

``THRESHOLDS`` is a table of (rule, ratio, lower bound, upper bound). ``compile_rules`` turns it into boolean columns
over the measured ratios; nothing but built-in functions runs, so the whole operator stays one scan without exchange.

Words are runs of characters other than space and the controls 9 to 13. A null text has no words. An empty text
fails the base rules, because it has fewer than ten words. Ratios of texts without words are 0. Rows are measured one by
one: ties and repeated rows get equal verdicts, null ids pass through, an empty table gives an empty result. Columns of
the input are not carried over unless asked for with ``keep``, which refuses the operator's own names (any case).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
POSITION_BITS = 24

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it for was on are with as be by this at from or an "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine als auch es "
    "le la les et en un une du dans que pour qui par sur pas au avec il elle est "
    "el los las y una del se con no por su al lo como más para o"
).split()
STOP_FORMS = sorted({form for word in STOP_WORDS for form in (word, word.capitalize(), word.upper())})
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")


@dataclass(frozen=True)
class Threshold:
    """A rule holds where ``low <= ratio <= high`` or the text has fewer than ``from_words`` words."""

    rule: str
    ratio: str
    low: float = float("-inf")
    high: float = float("inf")
    from_words: int = 0


THRESHOLDS = (
    Threshold("word_length", "mean_word_chars", 2.0, 20.0),
    Threshold("symbols", "symbols_per_word", high=0.5),
    Threshold("stop_words", "stop_word_share", low=0.005, from_words=60),
    Threshold("repeated_lines", "dup_line_share", high=0.5),
)


def words_of(text: Column) -> Column:
    """Array of the words of a non-null text."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def window_at(words: Column, at: Column) -> Column:
    return F.array_join(F.slice(words, at + 1, WINDOW), " ")


def suspect_positions(packed: Column) -> Column:
    """Positions whose fingerprint part agrees with that of a neighbour in the sorted array."""

    def agrees(item: Column, at: Column) -> Column:
        part = F.shiftright(item, POSITION_BITS)
        before = F.when(at > 0, F.shiftright(F.get(packed, at - 1), POSITION_BITS) == part)
        after = F.shiftright(F.get(packed, at + 1), POSITION_BITS) == part
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    return F.transform(
        F.filter(packed, agrees), lambda item: item.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")
    )


def repeated_positions(windows: Column) -> Column:
    """Ascending positions of the windows that occur at least twice in a sorted array of (window, position)."""

    def found(item: Column, at: Column) -> Column:
        before = F.when(at > 0, F.get(windows, at - 1)["w"] == item["w"])
        after = F.get(windows, at + 1)["w"] == item["w"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    return F.sort_array(F.transform(F.filter(windows, found), lambda item: item["at"]))


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts of every whole text: words, their code points, symbols, repeated lines, words in repeated windows.

    Equal windows have equal fingerprints, so only windows whose fingerprint part occurs twice are built as text and
    compared; a collision costs time and changes no result.
    """
    own = {*MEASURES, "base_failed", "kept", "_text", "_words", "_prints", "_packed", "_suspects", "_windows", "_lines"}
    if clashing := sorted(c for c in keep if c.lower() in own):
        raise ValueError(f"keep names columns of this operator: {clashing}")
    kept = [F.col(c) for c in keep]
    base = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    base = base.withColumn("_words", words_of(F.col("_text")))
    words = F.col("_words")
    n_windows = F.size(words) - (WINDOW - 1)
    prints = F.transform(
        F.sequence(F.lit(0), n_windows - 1),
        lambda at: F.xxhash64(*[F.get(words, at + k) for k in range(WINDOW)]),
    )
    base = base.withColumn("_prints", F.when(n_windows > 1, prints))
    prints = F.col("_prints")
    packed = F.transform(prints, lambda p, at: F.shiftleft(p, POSITION_BITS).bitwiseOR(at.cast("long")))
    suspicious = F.size(F.array_distinct(prints)) < F.size(prints)
    small = n_windows <= (1 << POSITION_BITS)
    base = base.withColumn("_packed", F.when(suspicious & small, F.sort_array(packed)))
    positions = F.when(
        suspicious, F.when(small, suspect_positions(F.col("_packed"))).otherwise(F.sequence(F.lit(0), n_windows - 1))
    )
    base = base.withColumn("_suspects", positions)
    spelled = F.transform("_suspects", lambda at: F.struct(window_at(words, at).alias("w"), at.alias("at")))
    base = base.withColumn("_windows", F.sort_array(spelled))
    covered = F.aggregate(
        repeated_positions(F.col("_windows")),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda seen, p: F.struct(
            (seen["n"] + F.least(F.lit(WINDOW), p - seen["last"])).cast("long").alias("n"), p.alias("last")
        ),
        lambda seen: seen["n"],
    )
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    base = base.withColumn("_lines", lines)
    return base.select(
        *kept,
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[" + SYMBOLS + "]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter(words, lambda w: w.isin(STOP_FORMS))).cast("long").alias("n_stop_words"),
    )


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "stop_word_share": ("n_stop_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
}


def compile_rules(thresholds: tuple[Threshold, ...] = THRESHOLDS) -> list[Column]:
    """One boolean column per row of the table, named after its rule."""
    compiled = []
    for row in thresholds:
        ratio = _share(*(F.col(c) for c in RATIOS[row.ratio]))
        holds = ratio.between(row.low, row.high) | (F.col("n_words") < row.from_words)
        compiled.append(holds.alias(row.rule))
    return compiled


def apply_rules(
    docs: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    thresholds: tuple[Threshold, ...] = THRESHOLDS,
) -> DataFrame:
    """Counts, one column per rule, ``base_failed`` and ``kept``."""
    if clashing := {c.lower() for c in keep} & {row.rule.lower() for row in thresholds}:
        raise ValueError(f"keep names rules: {sorted(clashing)}")
    measured = measure(docs, text, keep)
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = measured.select("*", *compile_rules(thresholds), base_failed.alias("base_failed"))
    verdict = ~F.col("base_failed")
    for row in thresholds:
        verdict = verdict & F.col(row.rule)
    return judged.withColumn("kept", verdict)
