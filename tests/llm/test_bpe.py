import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from voltide.llm import bpe
from voltide.llm.encoding import Encoder, read_ranks

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    None, "", " ", "   ", "x'", "it's we'LL  \n\n x\t\ty   ", "漢字かな交じり文 한국어 العربية", "ࡰࡱ 𖵰 \U0001f600 é", "a" * 700 + " " + "ab" * 300,
    "<|endoftext|> \x00\x1c\x85　 x", "der die das " * 50, "unglaubliche Überraschungen", "1234567890 12", "\r\n\r\n",
]


@pytest.fixture(scope="module")
def codec():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


@pytest.mark.parametrize("remembered", [0, 64, 4096])
def test_ids_equal_the_library(frame, codec, remembered):
    rows = [*enumerate(TEXTS), (None, "a b"), (10, TEXTS[10])]
    encoded = bpe.encode(frame(rows), RANKS, remembered=remembered).collect()
    assert len(encoded) == len(rows)
    for row in encoded:
        assert row.ids == codec.encode_ordinary(row.text or ""), row.text


def test_digests_and_decoding(frame, codec):
    for row in bpe.digests(frame(list(enumerate(TEXTS))), RANKS).collect():
        text = TEXTS[row.doc_id] or ""
        ids = codec.encode_ordinary(text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_remembering_encoder_equals_the_library(codec):
    own = Encoder(RANKS)
    for text in [t or "" for t in TEXTS] * 2:
        assert own.encode(text) == np.asarray(codec.encode_ordinary(text), "<u4").tobytes()


def test_clash_is_refused_and_empty_tables_pass(frame):
    with pytest.raises(ValueError, match="ids"):
        bpe.encode(frame([(1, "a", 1)], "doc_id long, text string, ids int"), RANKS)
    assert bpe.digests(frame([]), RANKS).count() == 0


def test_each_distinct_word_of_a_block_is_encoded_once(codec):
    merges, asked = bpe.Merges(read_ranks(RANKS)), []
    ids_of = merges.ids_of
    merges.ids_of = lambda words: asked.append(words) or ids_of(words)
    words = [" Xqvzt", " kjwpf", " Xqvzt", " the", "zz" * 90, " Xqvzt"]
    for remembered, again in ((1, 3), (8, 0)):
        memory, asked[:] = bpe.WordMemory(merges, remembered), []
        for _ in range(2):
            ids, sizes = memory.encode(pa.array(words))
            expected = [codec.encode_ordinary(word) for word in words]
            assert ids.tolist() == sum(expected, []) and sizes.tolist() == [len(e) for e in expected]
        assert [len(a) for a in asked] == [4, again]


def test_random_and_long_words_equal_the_library(codec):
    merges, random = bpe.Merges(read_ranks(RANKS)), np.random.default_rng(4)
    letters = list("etaoinshrdlu") + ["é", "漢", "ß", "Ж"]
    words = ["".join(random.choice(letters, n)) for n in random.integers(1, 150, 3000)] + ["ab" * 20_000, "a" * 9_999]
    ids, sizes = merges.ids_of(words)
    for word, found in zip(words, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
        assert found.tolist() == codec.encode_ordinary(word)


def test_blocks_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 3)
    rows = [["a"], [], ["b"] * 2, ["c"] * 7, [], ["d"] * 3, ["e"], []]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(rows, pa.list_(pa.string()))], names=["n", "words"])
    blocks = list(bpe._blocks(batch.slice(1)))
    assert [n for block in blocks for n in block["n"].to_pylist()] == list(range(1, 8))
    assert all(len(block["words"].flatten()) <= 3 or block.num_rows == 1 for block in blocks)
