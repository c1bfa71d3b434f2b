import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from voltide.llm import alignment

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    None,
    "",
    " ",
    "the same words in both vocabularies",
    " leading space, and  two  inside",
    "tabs\tand\nlines\r\n\n\n   with    runs",
    "a <|endoftext|> b <s> </s> <unk> <0x41>",
    "under▁score and ▁",
    "Überraschung naïve façade 漢字かな交じり 😀😀 \u0085  x",
    "=" * 300 + "-" * 77 + " " * 130 + "x",
    "áè \U0001fae8 \U0001f9ff ﬁ ＡＢＣ",
    "hello hello hello hello world",
    "zxqv kjwq vvvv anblewh sttible athawh thonre",
    "supercalifragilistic" * 400,
    "the the the the the the",
]


def byte_letters():
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in kept}
    letters |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}
    return {c: b for b, c in letters.items()}


def plain(rows):
    a_file, b_file = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_file.encode_special_tokens = True
    letters = byte_letters()
    kept, docs = [], Counter()
    for id, text in rows:
        groups = []
        if text:
            a = a_file.encode(" " + text, add_special_tokens=False).ids
            b = b_file.encode(text)
            a_bytes = [bytes(letters[c] for c in a_file.id_to_token(i)) for i in a]
            b_bytes = [
                bytes([int(b_file.id_to_piece(i)[3:5], 16)])
                if b_file.is_byte(i)
                else b_file.id_to_piece(i).replace("▁", " ").encode()
                for i in b
            ]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                a_ends, b_ends = [], []
                for parts, ends in ((a_bytes, a_ends), (b_bytes, b_ends)):
                    at = 0
                    for part in parts:
                        at += len(part)
                        ends.append(at)
                low = 0
                for cut in sorted(set(a_ends) & set(b_ends)):
                    groups.append(
                        (
                            [i for i, e in zip(a, a_ends) if low < e <= cut],
                            [i for i, e in zip(b, b_ends) if low < e <= cut],
                        )
                    )
                    low = cut
        links = Counter((x, y) for left, right in groups for x in left for y in right)
        docs.update(links.keys())
        kept.append((id, groups, links))
    top = defaultdict(int)
    for (x, _), n in docs.items():
        top[x] = max(top[x], n)
    out = []
    for id, groups, links in kept:
        shown = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        out.append(
            (
                id,
                sum(len(left) for left, _ in groups),
                sum(len(right) for _, right in groups),
                len(groups),
                sum(links.values()),
                sum(n for p, n in links.items() if docs[p] == top[p[0]]),
                sum(n * docs[p] for p, n in links.items()),
                hashlib.sha256(shown.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=repr)


def got(docs, **settings):
    table = alignment.align_documents(docs, JSON, RANKS, PIECES, **settings)
    assert table.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    ]
    return sorted(map(tuple, table.collect()), key=repr)


@pytest.mark.parametrize("remembered", [64, alignment.REMEMBERED])
def test_equals_plain_version(frame, remembered):
    rng = random.Random(3)
    letters = "etaoin shrdlu  cmfwyp\n,.ÄéßñΩж漢字😀▂"
    rows = [(i, text) for i, text in enumerate(TEXTS)] + [(None, "the null id"), (3, TEXTS[3]), (3, TEXTS[3])]
    rows += [(100 + i, "".join(rng.choices(letters, k=rng.randint(1, 200)))) for i in range(150)]
    assert got(frame(rows), remembered=remembered) == plain(rows)


def test_empty_table_and_clashing_columns(frame):
    assert got(frame([])) == []
    assert got(frame([(1, None), (2, "")])) == plain([(1, None), (2, "")])
    rows = [(i, text, i, i) for i, text in enumerate(TEXTS[:6])]
    wide = frame(rows, "doc_id long, text string, row int, pair int")
    assert got(wide) == plain([row[:2] for row in rows])


def test_spans_cover_everything():
    rng = random.Random(5)
    for _ in range(300):
        size = rng.randint(1, 60)
        share = rng.random()
        a = [i for i in range(1, size) if rng.random() < share] + [size]
        b = [i for i in range(1, size) if rng.random() < share or i in a] + [size]
        groups = []
        for i, j, n, m in alignment.spans(a, b):
            groups += [(a[i : i + n], b[j : j + m])] if m else [([a[i + k]], [b[j + k]]) for k in range(n)]
        ends = sorted(set(a) & set(b))
        assert [left[-1] for left, _ in groups] == ends == [right[-1] for _, right in groups]
        assert sum((left for left, _ in groups), []) == a and sum((right for _, right in groups), []) == b


def test_portions_do_not_change_the_result():
    tool = alignment.Aligner(JSON, RANKS, PIECES)
    tokens = [found for found in map(tool.tokens, TEXTS) if found]
    together = list(tool.align(tokens))
    for found, one in zip(tokens, together, strict=True):
        (alone,) = tool.align([found])
        assert alone[:3] == one[:3]
        assert all((x == y).all() for x, y in zip(alone[3:], one[3:], strict=True))
