import zlib

import numpy as np
import pytest

from voltide.llm import classifier

SMALL = classifier.Settings(buckets=1 << 12, dim=8, epochs=20)


def made(n):
    good = "The house of the river was long and the way to the hill is green"
    rows = []
    for k in range(n):
        words = good.split()
        turn = words[k % 7 :] + words[: k % 7] + [f"name{k}"]
        bad = " ".join(f"{w.upper()}###" for w in turn) if k % 3 == 0 else None
        rows.append((k, bad or " ".join(turn), 0 if bad else 1))
    return rows


def test_learns_and_holds_out(frame):
    rows = made(300)
    docs = frame([(i, t) for i, t, _ in rows] + [(None, "the house"), (1000, None), (1001, ""), (3, rows[3][1])])
    labels = frame([(i, q, None) for i, _, q in rows] + [(7, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = classifier.fit(docs, labels, settings=SMALL)
    scored = classifier.score_documents(docs, model).collect()
    assert len(scored) == 304
    truth = {i: q for i, _, q in rows}
    for row in scored:
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
        assert row.held_out == (zlib.crc32(str("" if row.doc_id is None else row.doc_id).encode()) % 5 == 0)
        if row.doc_id in truth:
            assert row.predicted == truth[row.doc_id]
    kept = classifier.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id in truth) == sorted(i for i, q in truth.items() if q)


def test_scores_are_the_softmax_of_the_averaged_rows():
    random = np.random.default_rng(1)
    model = classifier.untrained(SMALL)
    model.output[:] = random.normal(size=model.output.shape)
    model.bias[:] = (0.3, -0.2)
    score = classifier.scorer(model)
    for text in ["", "one", "the the the long word " + "x" * 60, "a b c a b c d"]:
        rows, weights = classifier.bag(text, SMALL)
        logits = (weights @ model.table[rows]) @ model.output + model.bias
        expected = np.exp(logits[1]) / np.exp(logits).sum()
        assert score(text) == pytest.approx(expected, abs=1e-5) and score(text) == score(text)


def test_training_rows_are_bounded_and_not_held_out(frame):
    rows = made(200)
    docs = frame([(i, t) for i, t, _ in rows])
    labels = frame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    chosen = classifier.sample(docs, labels, "quality", 50).collect()
    assert len(chosen) == 50
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in chosen)


def test_without_labels_every_score_is_half(frame):
    labels = frame([], "doc_id long, quality int")
    model = classifier.fit(frame([(1, "a")]), labels, settings=SMALL)
    assert [r.score for r in classifier.score_documents(frame([(1, "a"), (2, None)]), model).collect()] == [0.5, 0.5]
    assert classifier.score_documents(frame([]), model).count() == 0


def test_held_out_accuracy_on_the_generated_documents(spark):
    from voltide.llm.queries import op6_subword_classifier

    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = op6_subword_classifier(spark, sf_dir).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9


def test_rows_of_many_words_are_those_of_each():
    words = ["a", "word", "naïve", "漢字かな", "\U0001f600!", classifier.CLOSING, "x" * 300, "<>", "Ж", "\x00"]
    for chosen in (words, ["plain", "ascii"], *[[word] for word in words]):
        rows, sizes = classifier.rows_of_words(chosen, SMALL)
        for word, found in zip(chosen, np.split(rows, np.cumsum(sizes)[:-1]), strict=True):
            assert sorted(found) == sorted(classifier.features_of(word, SMALL))


def test_scoring_computes_the_features_of_new_words_together(monkeypatch):
    asked, rows_of_words = [], classifier.rows_of_words
    monkeypatch.setattr(classifier, "rows_of_words", lambda words, s: asked.append(sorted(words)) or rows_of_words(words, s))
    score = classifier.scorer(classifier.untrained(SMALL))
    assert score("one two two") == score("one two two")
    assert asked == [sorted({"one", "two", classifier.CLOSING, classifier.TWICE})]
