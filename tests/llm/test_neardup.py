import importlib
import random

import numpy as np
import pytest

from voltide.llm import neardup
from voltide.llm.components import components


def sentence(random_, n):
    return " ".join(f"w{random_.randint(0, 3000)}" for _ in range(n))


def changed(random_, text, share):
    words = text.split()
    for k in random_.sample(range(len(words)), max(1, int(share * len(words)))):
        words[k] = f"new{random_.randint(0, 10**6)}"
    return " ".join(words)


def brute(rows, weights):
    bags = []
    for _, text in rows:
        hashes, counts = neardup.shingles(neardup.words_of(text))
        bags.append((hashes, weights(hashes, counts)))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if neardup.weighted_jaccard(bags[i], bags[j]) >= neardup.SIMILARITY:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    classes = {}
    for i, (doc_id, _) in enumerate(rows):
        classes.setdefault(root(i), []).append(doc_id)
    out = []
    for ids in classes.values():
        first = min((i for i in ids if i is not None), default=None)
        out += [(i, first, len(ids)) for i in ids]
    return sorted(out, key=repr)


def corpus():
    random_ = random.Random(5)
    rows = []
    for _ in range(12):
        text = sentence(random_, random_.choice([8, 40, 200, 600]))
        rows += [text, text.upper(), "  " + text.replace(" ", "\n")]
        rows += [changed(random_, text, share) for share in (0.005, 0.01, 0.02, 0.04, 0.1)]
    chain = sentence(random_, 300)
    for _ in range(12):  # each near its neighbour, the ends far apart
        rows.append(chain)
        chain = changed(random_, chain, 0.015)
    shared = sentence(random_, 150)
    rows += [f"{shared} {sentence(random_, 60)}" for _ in range(30)]
    rows += [None, "", " ", "one", "one", "two words", "a b c d e f", "a a a a a a a a a a a"]
    random_.shuffle(rows)
    return [(k, text) for k, text in enumerate(rows)]


@pytest.mark.parametrize("block", [512, 4])
def test_classes_equal_brute_force(frame, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "TEXT_BLOCK", block)
    rows = corpus()
    docs = frame(rows)
    got = neardup.groups(docs).collect()
    expected = brute(rows, neardup.Weights.of(docs, "text"))
    assert sorted(((r.doc_id, r.class_id, r.group_size) for r in got), key=repr) == expected
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_repeated_rows_missing_ids_and_other_columns(frame):
    text = "this is a text of some more than ten words in all here"
    rows = [(None, text, 1), (4, text, 2), (4, text, 3), (9, None, 4), (None, "", 5), (8, "else", 6)]
    docs = frame(rows, "doc_id long, text string, d1 int")
    got = neardup.groups(docs).collect()
    assert len(got) == 6 and sum(r.kept for r in got) == 3
    assert {(r.class_id, r.group_size) for r in got} == {(4, 3), (9, 2), (8, 1)}
    kept = neardup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.d1) for r in kept.collect()) == [(4, 2), (8, 6), (9, 4)]


def test_empty_table(frame):
    assert neardup.groups(frame([])).count() == 0
    assert neardup.groups(frame([(1, None)])).count() == 1


def test_samples_agree_as_often_as_texts_are_similar():
    random_, sampler = np.random.default_rng(3), neardup.Sampler()
    for share in (0.3, 0.8, 0.95):
        estimates, real = [], []
        for _ in range(30):
            hashes = np.unique(random_.integers(0, 1 << 63, 400, dtype=np.uint64))
            weights = random_.uniform(1, 2, len(hashes)).astype(np.float32)
            weights[::7] *= 3
            common = random_.random(len(hashes))
            a, b = common < share + (1 - share) / 2, common > (1 - share) / 2
            bags = [(hashes[a], weights[a]), (hashes[b], weights[b])]
            drawn = sampler(
                np.concatenate([bags[0][0], bags[1][0]]),
                np.concatenate([bags[0][1], bags[1][1]]),
                np.asarray([a.sum(), b.sum()]),
            )
            estimates.append((drawn[0] == drawn[1]).mean())
            real.append(neardup.weighted_jaccard(*bags))
        assert abs(np.mean(estimates) - np.mean(real)) < 0.03


def test_components_of_chains_stars_and_rings(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(500, 500 + k) for k in range(1, 80)]
    ring = [(1000 + k, 1000 + (k + 1) % 30) for k in range(30)]
    rows = [*chain, *star, *ring, *star[:5], (7, 7)]
    named = components(spark.createDataFrame(rows, "a long, b long")).collect()
    groups = {}
    for row in named:
        groups.setdefault(row.component, set()).add(row.v)
    assert sorted(map(len, groups.values())) == [30, 61, 80]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("chars", [6_000_000, 3_000])
def test_weights_are_those_of_exact_document_frequencies(frame, monkeypatch, chars):
    monkeypatch.setattr(neardup, "BLOCK_CHARS", chars)
    random_ = random.Random(8)
    shared = sentence(random_, 30)
    rows = [(k, f"{shared} {sentence(random_, 400)}") for k in range(700)]  # about 280,000 shingles
    weights = neardup.Weights.of(frame(rows), "text")
    bags = [neardup.shingles(neardup.words_of(text)) for _, text in rows]
    found, frequency = np.unique(np.concatenate([hashes for hashes, _ in bags]), return_counts=True)
    exact = 1 + np.log((len(rows) + 1) / (frequency + 1)) / np.log(len(rows) + 1)
    assert frequency.max() == 700 and (frequency == 1).sum() > 200_000
    assert np.allclose(weights(found, np.ones(len(found))), exact, rtol=1e-6)


def test_few_values_give_the_samples_of_all(monkeypatch):
    random_, sampler, computed = np.random.default_rng(8), neardup.Sampler(), []
    sizes = np.asarray([600, 1, 3, 400, 50])
    hashes = np.concatenate([np.unique(random_.integers(0, 1 << 63, n, dtype=np.uint64) * 2 + 1) for n in sizes])
    weights = (random_.uniform(1, 2, len(hashes)) * random_.choice([1, 1, 1, 1, 7], len(hashes))).astype(np.float32)
    weights[-50:] *= 0.3
    values = neardup.Sampler.values
    monkeypatch.setattr(neardup.Sampler, "values", lambda self, at, logs: computed.append(len(at)) or values(self, at, logs))
    found = sampler(hashes, weights, sizes)
    starts = np.cumsum(sizes) - sizes
    for k, turn in enumerate(sampler.turns):
        every, steps = values(sampler, (hashes * turn >> np.uint64(64 - neardup.TABLE_BITS)).astype(int), np.log(weights))
        for row, (start, size) in enumerate(zip(starts, sizes, strict=True)):
            at = start + int(every[start : start + size].argmin())
            mixed = hashes[at : at + 1] + steps[at].astype(np.int64).astype(np.uint64) * neardup._MIX + turn
            assert found[row, k] == neardup._mixed(mixed)[0]
    computed.clear()
    sampler(hashes[:600], np.minimum(np.maximum(weights[:600], 1), 2), np.asarray([600]))
    assert sum(computed) < 0.1 * 600 * neardup.SAMPLES


def test_wanted_texts_come_from_the_blocks_in_less_space(frame):
    texts = ["the long and the short of the long way " * 30, None, "x"]
    blocks = neardup.blocked(frame(list(enumerate(texts))), "doc_id", "text")
    ids = {row.id: row.row_id for row in blocks.collect()}
    wanted = frame([(ids[0],), (ids[1],)], "v long")
    found = {row.v: row for row in neardup.fetch_texts(blocks, wanted, neardup.sketches(blocks, 3)).collect()}
    assert {v: neardup.unpacked(bytes(row.text)) for v, row in found.items()} == {ids[0]: texts[0], ids[1]: ""}
    assert len(found[ids[0]].text) < 0.5 * len(texts[0])


def test_new_links_contract_only_the_components_they_join(spark, monkeypatch):
    module, staged = importlib.import_module("voltide.llm.components"), []
    chains = [(1000 * c + k, 1000 * c + k + 1) for c in range(1, 7) for k in range(40)]
    links = [(1007, 2031), (2003, 3030), (3005, 1), (1, 2), (9, 8), (4001, 4009)]
    named = components(spark.createDataFrame(chains, "a long, b long"))
    stage = module.stage
    monkeypatch.setattr(module, "stage", lambda df, tag: staged.append((tag, stage(df, tag))) or staged[-1][1])
    found = module.extended(named, spark.createDataFrame(links, "a long, b long")).collect()
    assert max(df.count() for tag, df in staged if tag == "edges") <= 5
    classes = {}
    for row in found:
        classes.setdefault(row.component, set()).add(row.v)
    assert len(found) == 6 * 41 + 4 and sorted(map(len, classes.values())) == [2, 41, 41, 41, 3 * 41 + 2]
    assert all(name in members for name, members in classes.items())


def test_links_are_contracted_once(frame, monkeypatch):
    given = []
    monkeypatch.setattr(neardup, "components", lambda links: given.append({(r.a, r.b) for r in links.collect()}) or components(links))
    rows = corpus()
    got = neardup.groups(frame(rows)).collect()
    assert len(got) == len(rows) and len(given) <= 2
    if len(given) > 1:
        assert not given[0] & given[1]


def test_frequencies_are_written_before_texts_travel(frame, monkeypatch):
    plans, stage = {}, neardup.stage

    def seen(df, tag):
        plans[tag] = df._jdf.queryExecution().toString()
        return stage(df, tag)

    monkeypatch.setattr(neardup, "stage", seen)
    docs = frame([(k, f"some words of a text with number {k % 3} in it") for k in range(9)])
    assert neardup.sketches(neardup.blocked(docs, "doc_id", "text"), 9).count() == 9
    assert "FlatMapGroupsInArrow" in plans["shared-frequencies"]
    assert "FlatMapCoGroupsInArrow" in plans["sketches"] and "FlatMapGroupsInArrow" not in plans["sketches"]
