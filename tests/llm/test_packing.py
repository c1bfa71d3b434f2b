import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from voltide.llm import packing
from voltide.llm.encoding import TokenizerFile

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [
    None, "", "one two", "word " * 6000, "a" * 3000, "x", "x", "tab\t\tand  blanks \n\n here ", "don't we'll 漢字 ÀÉ",
    "\U0001fae0 ࡰࡱ new letters", " lead", "trail ", "\x1c\x85　odd blanks", "<|endoftext|> first",
    "a <|endoftext|> b",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(JSON)


def test_ids_equal_the_tokenizer_file(tokenizer):
    own = TokenizerFile(JSON, RANKS)
    for text in TEXTS:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert own.encode(text or "") == np.asarray(ids, "<u4").tobytes()


def test_added_tokens_have_their_ids(tokenizer):
    text = "a <|endoftext|> b"
    assert 50256 in np.frombuffer(TokenizerFile(JSON, RANKS).encode(text), "<u4")
    tokenizer.encode_special_tokens = True
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    tokenizer.encode_special_tokens = False
    plain = TokenizerFile(JSON, RANKS, plain=True)
    assert plain.encode(text) == plain._by_file(text) == np.asarray(ids, "<u4").tobytes()


def test_characters_of_old_unicode_split_alike(tokenizer):
    import unicodedata

    own = TokenizerFile(JSON, RANKS)
    codes = [c for c in range(1, 0x3100) if unicodedata.ucd_3_2_0.category(chr(c)) != "Cn"]
    for at in range(0, len(codes), 40):
        text = " ".join(f"a{chr(c)}b 1{chr(c)} {chr(c)}." for c in codes[at : at + 40])
        assert own.ranks.encode(text) == np.asarray(
            tokenizer.encode(text, add_special_tokens=False).ids, "<u4"
        ).tobytes()


def test_packed_pieces_rebuild_every_document(frame, tokenizer):
    rows = [*enumerate(TEXTS), (None, "no id"), (5, "x")]
    packed = packing.pack_documents(frame(rows)).collect()
    by_id = {}
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        by_id[doc_id] = ids
        assert sum(p.length for p in packed if p.doc_id == doc_id) == len(ids) * sum(r[0] == doc_id for r in rows)
    for p in packed:
        part = by_id[p.doc_id][p.start : p.start + p.length]
        assert zlib.crc32(np.asarray(part, "<u4").tobytes()) == p.ids_crc32
        assert p.piece == 0 or p.length == 2048
    check_places(packed, 2048)


def check_places(packed, capacity):
    places = {}
    for p in packed:
        places.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_is_close_to_the_bound(frame, seed):
    random_ = random.Random(seed)
    lengths = [random_.choice([1, 3, random_.randint(1, 100), random_.randint(1, 60)]) for _ in range(700)]
    runs = frame([(k, n) for k, n in enumerate(lengths)], "doc_id long, length long")
    packed = packing.pack(runs, 100, part=50).collect()
    assert sorted(p.doc_id for p in packed) == list(range(700))
    assert check_places(packed, 100) <= sum(lengths) / 100 * 1.02 + 1


def test_sweep_places_each_rank_once_and_takes_the_smallest_gap():
    places = packing.sweep({6: 1, 5: 1, 4: 1, 3: 1}, 10)
    assert {p[0]: (p[4], p[5]) for p in places} == {6: (0, 0), 4: (0, 6), 5: (1, 0), 3: (1, 5)}
    counts = {n: 37 * n % 11 + 1 for n in range(1, 50)}
    taken = {}
    for size, first, last, *_ in packing.sweep(counts, 64):
        taken.setdefault(size, []).append((first, last))
    for size, spans in taken.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] == counts[size]
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_cut_leaves_the_short_piece_first():
    assert packing.cut(1, 4) == [(0, 1)]
    assert packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_sequences_hold_their_pieces_in_order(frame):
    docs = frame([(1, "a b c"), (2, "d e"), (3, None)])
    held = packing.pieces(docs, JSON, RANKS, capacity=16, with_ids=True)
    rows = packing.sequences(packing.pack(held, 16)).collect()
    assert [len(r.ids) for r in rows] == [4 * r.length for r in rows] and sum(r.length for r in rows) == 8
    assert all(bytes(r.ids).endswith(b"\0\0\0\0") for r in rows)


def test_empty_table(frame):
    assert packing.pack_documents(frame([])).count() == 0
