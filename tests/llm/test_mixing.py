import hashlib
import math
from collections import defaultdict

import pytest

from voltide.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def plain(rows, weights=(3, 1, 2), share=1.5, limit=2):
    """Targets by rounds, documents in order of their draw."""
    sized = []
    for id, text, source in rows:
        digest = hashlib.md5(f"mix:{'' if id is None else id}:{text or ''}".encode()).hexdigest()
        cleaned = "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "")
        sized.append((id, source, sum(1 for w in cleaned.split(" ") if w), int(digest[:15], 16)))
    size = defaultdict(int)
    for _, source, n, _ in sized:
        size[source] += n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed = set()
    while True:
        free = sum(weight[s] for s in order if s not in fixed)
        if not free:
            break
        level = (share * sum(size.values()) - sum(limit * size[s] for s in fixed)) / free
        over = {s for s in order if s not in fixed and weight[s] * level > limit * size[s]}
        if not over:
            break
        fixed |= over
    target = {s: float(limit * size[s]) if s in fixed else weight[s] * level for s in order}
    taken = {}
    for source in order:
        passes = math.floor(target[source] / size[source]) if size[source] else 0
        goal, done = target[source] - passes * size[source], 0
        draws = defaultdict(list)
        for row in sized:
            if row[1] == source:
                draws[row[3]].append(row)
        open_ = True
        for draw in sorted(draws):
            more = sum(row[2] for row in draws[draw])
            once = open_ and (done + more <= goal or done + more - goal < goal - done)
            open_ = open_ and done + more <= goal
            done += more
            for row in draws[draw]:
                taken[row] = row[2] * (passes + once)
    return sorted(
        ((id, n, size[s], round(target[s], 6), taken[id, s, n, d]) for id, s, n, d in sized), key=repr
    )


def words(n, word="ab"):
    return " ".join([word] * n)


CASES = {
    "hot source": [(i, words(1 + i * 7 % 40), "a" if i % 3 else f"s{i % 11}") for i in range(400)],
    "nulls and empties": [(None, "x y", None), (1, None, "a"), (2, "", "b"), (3, "one\ttwo\n three", None), (4, "q", "")],
    "repeated rows": [(5, words(9), "a")] * 4 + [(6, words(30), "a"), (7, words(11), "b")],
    "one long text": [(1, words(50_000), "a"), (2, words(3), "a"), (3, words(3), "z")],
    "no words": [(1, None, "a"), (2, " \n", "b")],
}


@pytest.mark.parametrize("name", CASES)
def test_equals_plain_version(frame, name):
    got = mixing.mix(frame(CASES[name], SCHEMA)).collect()
    assert sorted(((*r[:3], round(r[3], 6), r[4]) for r in got), key=repr) == plain(CASES[name])


def test_empty_table(frame):
    assert mixing.mix(frame([], SCHEMA)).collect() == []


def test_near_target_and_limits(frame):
    rows = CASES["hot source"]
    got = mixing.mix(frame(rows, SCHEMA)).collect()
    source = {id: s for id, _, s in rows}
    sums, target = defaultdict(int), {}
    for r in got:
        assert r.taken % r.size == 0 and r.taken <= 2 * r.size
        sums[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(sums[s] - target[s]) <= 20 for s in sums)  # half of the longest text
    assert got and sorted(got) == sorted(mixing.mix(frame(rows, SCHEMA, partitions=7)).collect())


def test_smaller_budgets_are_nested(frame):
    rows = frame(CASES["hot source"], SCHEMA)
    small = {r.doc_id: r.taken for r in mixing.mix(rows, weights=(1,), share=0.3).collect()}
    large = {r.doc_id: r.taken for r in mixing.mix(rows, weights=(1,), share=0.7).collect()}
    assert all(small[id] <= large[id] for id in small) and sum(small.values()) < sum(large.values())


def test_mixed_documents_keep_columns_and_repeat(frame):
    rows = [(*row, 1.0, "k") for row in CASES["hot source"]]
    docs = frame(rows, SCHEMA + ", mix_source double, passes string")
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    mixed = mixing.mixed(docs)
    assert mixed.columns == [*docs.columns, "copy"]
    found = defaultdict(int)
    for r in mixed.collect():
        found[r.doc_id] += len(r.text.split())
    assert {id: n for id, n in taken.items() if n} == dict(found)
    with pytest.raises(ValueError):
        mixing.mixed(docs.withColumnRenamed("passes", "Copy"))
