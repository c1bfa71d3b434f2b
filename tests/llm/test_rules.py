import collections
import re

import pytest

from voltide.llm import rules

BLANK = "\x20\x09-\x0d"


def brute(text):
    text = text or ""
    words = re.findall(f"[^{BLANK}]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines, seen, again = text.split("\n"), set(), 0
    for line in lines:
        if re.search(f"[^{BLANK}]", line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        again,
        len(covered),
        failed,
    )


TEXTS = [
    None,
    "",
    "   \t\n ",
    "one",
    "a b c d e",
    "a b c d e a b c d e",
    "a a a a a a a",
    "the cat sat on the mat and the dog of the house is in it\n" * 3,
    "x\n\nx\n x\nx",
    "é𝄞 #*$%&|<> \x0b\x0c\r word word   \x1c y",
    " ".join(f"w{i % 97}" for i in range(5000)),
    " ".join(f"w{i}" for i in range(30000)),
    "is " * 400,
    "It is the first of the lines and it was long enough to be read by all of them.",
]


def test_counts_equal_brute_force(frame):
    rows = rules.apply_rules(frame(list(enumerate(TEXTS)))).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        got = (
            row.n_words,
            row.word_chars,
            row.n_symbols,
            row.n_dup_lines,
            row.n_repeat_words,
            row.base_failed,
        )
        assert got == brute(TEXTS[row.doc_id]), row.doc_id
        assert not (row.base_failed and row.kept)


def test_many_words_beyond_the_packed_positions(frame, monkeypatch):
    monkeypatch.setattr(rules, "POSITION_BITS", 3)
    texts = ["a b c d e f g h i j a b c d e f", "a b c d e " * 5, "p q r s t u v w x y z"]
    for row in rules.apply_rules(frame(list(enumerate(texts)))).collect():
        assert row.n_repeat_words == brute(texts[row.doc_id])[4]


def test_plain_prose_is_kept_and_symbols_are_not(frame):
    prose = "This is a text of plain words that was written for the test and it has no rare marks in it at all."
    noisy = " ".join(f"w{i}###" for i in range(80))
    kept = {r.doc_id: r.kept for r in rules.apply_rules(frame([(1, prose), (2, noisy)])).collect()}
    assert kept == {1: True, 2: False}


def test_plan_has_no_exchange_and_no_python(frame, spark):
    spark.range(3).selectExpr("id doc_id", "cast(id as string) text").createOrReplaceTempView("plain")
    plan = rules.apply_rules(spark.table("plain"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("extra", ["n_words", "kept", "_text", "_words"])
def test_clashing_columns_and_empty_tables(frame, extra):
    docs = frame([(None, "a b", 7), (None, None, 8)], f"doc_id long, text string, {extra} int")
    assert [r.n_words for r in rules.apply_rules(docs).orderBy("n_words").collect()] == [0, 2]
    assert rules.apply_rules(frame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        rules.apply_rules(docs, keep=("doc_id", extra))


def test_kept_columns_stay(frame):
    docs = frame([(1, "a b", 7)], "doc_id long, text string, lang int")
    (row,) = rules.apply_rules(docs, keep=("doc_id", "lang")).collect()
    assert (row.doc_id, row.lang, row.n_words) == (1, 7, 2)
    with pytest.raises(ValueError):
        rules.apply_rules(docs.withColumnRenamed("lang", "Symbols"), keep=("Symbols",))
