import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from voltide.llm import importance

LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ROWS = (
    [(i, " ".join(f"Word{(i * k) % 97}_x" for k in range(1, 5 + i % 60))) for i in range(300)]
    + [(1000 + i, f"quiz question number {i} " * 8) for i in range(40)]
    + [(None, "null id " * 15), (2000, None), (2001, ""), (2002, "--- !!!"), (2003, "ÄÖ É漢字 A1b"), (2004, LONG)]
    + [(3000, "same row twice " * 9)] * 2
)
TARGET = [(i, f"A quiz question number {i}? Answer {i % 7}.") for i in range(50)] + [(90, None)]


def features(text, ngram):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[i : i + n]) for n in range(1, ngram + 1) for i in range(len(words) - n + 1)]


def plain(rows, target, buckets, ngram, percent, min_words):
    def count(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for _, text in texts for f in features(text, ngram)[1])

    source, aimed = count(rows), count(target)
    s_all, t_all = sum(source.values()), sum(aimed.values())
    out = []
    for id, text in rows:
        words, found = features(text, ngram)
        gain = 0
        for f in found:
            b = zlib.crc32(f.encode()) % buckets
            gain += math.floor(
                1000 * math.log((aimed[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets)))
            )
        weight = gain // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if id is None else id}".encode()).hexdigest()[:8], 16)
        out.append([id, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[2], -r[3]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = rank
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("settings", [(10_000, 1, 10, 20), (64, 3, 35, 5), (10_000, 2, 100, 0)])
def test_equals_plain_version(frame, settings):
    buckets, ngram, percent, min_words = settings
    got = importance.draw(
        frame(ROWS), frame(TARGET), buckets=buckets, ngram=ngram, percent=percent, min_words=min_words
    )
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(ROWS, TARGET, *settings)


def test_empty_tables(frame):
    assert importance.draw(frame([]), frame(TARGET)).collect() == []
    got = importance.draw(frame(ROWS), frame([])).collect()
    assert sorted(map(tuple, got), key=repr) == plain(ROWS, [], 10_000, 1, 10, 20)


def test_all_scores_tied(frame, monkeypatch):
    monkeypatch.setattr(importance, "noise", lambda seed, id: 7)
    rows = [(i, "one two three four " * 6) for i in range(200)]
    got = {r.doc_id: r["rank"] for r in importance.draw(frame(rows), frame(TARGET)).collect()}
    assert got == {i: i + 1 if i < 20 else None for i in range(200)}


def test_resample_keeps_columns(frame):
    rows = [(i, text, i) for i, (_, text) in enumerate(ROWS)]
    docs = frame(rows, "doc_id long, text string, drawn_id int")
    drawn = importance.resample(docs, frame(TARGET))
    ranks = {r.doc_id: r["rank"] for r in importance.draw(docs, frame(TARGET)).collect() if r["rank"]}
    assert drawn.columns == ["doc_id", "text", "drawn_id", "rank"]
    assert {r.doc_id: r["rank"] for r in drawn.collect()} == ranks
    with pytest.raises(ValueError):
        importance.resample(docs.withColumnRenamed("drawn_id", "Rank"), frame(TARGET))
