import hashlib
import random
import re

import pytest

from voltide.llm import naming


def normal(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(normal(text), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            out.append((i, min(known, default=None), len(ids), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def texts(n):
    random_ = random.Random(4)
    base = ["", " ", "a", "a  b", "a b", "a\tb", " ", "é" * 50, "x" * 64, "x" * 65, "ab" * 1000, "ab" * 1000 + "c"]
    rows = [(i, random_.choice([*base, None])) for i in range(n)]
    return [*rows, (n, "y" * 300_000), (n + 1, "y" * 300_000), (n + 2, "y" * 299_999 + "z")]


@pytest.mark.parametrize("block_bytes", [1, 7, 8192])
def test_groups_equal_brute_force(frame, block_bytes):
    rows = texts(60)
    if block_bytes == 1:
        rows = [(i, (t or "")[:200]) for i, t in rows]
    elif block_bytes == 7:
        rows = [(i, (t or "")[:3000]) for i, t in rows]
    got = naming.groups(frame(rows), block_bytes=block_bytes).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_repeated_rows_and_missing_ids_keep_one_each(frame):
    rows = [(1, "a b"), (1, "a  b"), (None, "a b"), (None, "c"), (None, "c"), (2, None), (3, "")]
    got = naming.groups(frame(rows)).collect()
    assert len(got) == 7 and sum(r.kept for r in got) == 3
    assert {(r.keep_id, r.group_size) for r in got} == {(1, 3), (None, 2), (2, 2)}


def test_a_collision_of_fingerprints_moves_to_the_next_seed(frame, monkeypatch):
    plain, seeds = naming.fingerprint, []

    def colliding(block, seed):
        from pyspark.sql import functions as F

        seeds.append(seed)
        if seed == 0:
            return F.struct(F.lit(1).cast("long").alias("h1"), F.lit(2).cast("long").alias("h2"))
        return plain(block, seed)

    monkeypatch.setattr(naming, "fingerprint", colliding)
    got = naming.groups(frame([(1, "a"), (2, "b"), (3, "a")])).collect()
    assert {(r.doc_id, r.keep_id) for r in got} == {(1, 1), (2, 2), (3, 1)}
    assert max(seeds) == 1


def test_deduplicate_keeps_columns_and_one_row(frame):
    rows = [(1, "a  b", 5), (1, "a b", 6), (2, "a b", 7), (3, None, 8), (4, "z", None)]
    docs = frame(rows, "doc_id long, text string, digest int")
    kept = naming.deduplicate(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id: r.digest for r in kept.collect() if r.doc_id > 1} == {3: 8, 4: None}
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]


def test_empty_table_and_no_python_in_the_plan(frame, spark):
    assert naming.groups(frame([])).count() == 0
    plan = naming.groups(spark.sql("select 1L doc_id, 'a' text"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
