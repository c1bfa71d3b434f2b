import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from voltide.llm import edits
from voltide.llm.encoding import encoder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = ["'", "r", "e", "'re", "'s", " ", "  ", "\n", "ll", "é", "12", ". ", "word ", "漢", "\t", ""]
TEXT = st.lists(st.sampled_from(PARTS), max_size=120).map("".join)
CHANGE = st.tuples(st.integers(0, 260), st.integers(0, 40), st.lists(st.sampled_from(PARTS), max_size=12).map("".join))


@settings(max_examples=150, deadline=None)
@given(TEXT, st.lists(CHANGE, max_size=6))
def test_counts_follow_any_edits(text, changes):
    codec = encoder(RANKS)
    count = edits.Counter(codec)
    tree = edits.build(text, count)
    for start, removed, inserted in changes:
        at = min(start, len(text))
        expected = text[:at] + inserted + text[at + removed :]
        text, tree, _ = edits.edit(text, tree, start, removed, inserted, count)
        assert text == expected
        assert tree.tokens[1] == len(codec.codec.encode_ordinary(text))
        assert tree.chars[1] == len(text)
        inner = range(1, tree.width)
        assert all(tree.tokens[k] == tree.tokens[2 * k] + tree.tokens[2 * k + 1] for k in inner)


def test_a_small_edit_of_a_long_text_reads_a_small_part():
    count = edits.Counter(encoder(RANKS))
    text = "some words in a line. " * 20_000
    tree = edits.build(text, count)
    _, after, encoded = edits.edit(text, tree, 200_000, 3, "other ", count)
    assert encoded < 1000
    assert after.tokens[1] != 0


def test_table_of_documents_and_edits(frame):
    docs = frame([(1, "one two three"), (2, None), (3, ""), (None, "x y"), (5, "same"), (5, "same")])
    changes = frame(
        [(1, 1, 0, 3, "four"), (1, 2, 4, 0, None), (2, 1, 9, 9, "new text"), (5, 1, -4, 100, "")],
        "doc_id long, turn int, start int, removed int, inserted string",
    )
    joined = docs.join(edits.collect_edits(changes), "doc_id", "left")
    rows = edits.apply_edits(edits.plant(joined, RANKS), RANKS).collect()
    texts = sorted((r.doc_id or 0, r.text) for r in rows)
    assert texts == [(0, "x y"), (1, "four two three"), (2, "new text"), (3, ""), (5, ""), (5, "")]
    codec = encoder(RANKS).codec
    assert all(r.n_tokens_edited == len(codec.encode_ordinary(r.text)) for r in rows)
    assert edits.plant(frame([]), RANKS).count() == 0


def test_query_equals_encoding_the_edited_texts(spark, sf_dir):
    from pyspark.sql import functions as F

    from voltide.llm.queries import op9_edited_token_counts

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    drawn = docs.select("doc_id", "text", edits.drawn_edits(F.col("doc_id"), F.col("text")).alias("edits")).collect()
    codec = encoder(RANKS).codec
    expected = {}
    for row in drawn:
        text = row.text
        for change in row.edits:
            text = text[: change.start] + change.inserted + text[change.start + change.removed :]
        expected[row.doc_id] = (len(codec.encode_ordinary(row.text)), len(codec.encode_ordinary(text)), len(text))
    got = {r.doc_id: (r.n_tokens, r.n_tokens_edited, r.n_chars_edited) for r in op9_edited_token_counts(spark, sf_dir).collect()}
    assert got == expected
