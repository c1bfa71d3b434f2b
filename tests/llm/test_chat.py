import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from voltide.llm import chat
from voltide.llm.encoding import encoder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "conv_id long, turn long, role string, text string"
CONTROLS = ["<|turn|>", "<|text|>", "<|end|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_end|>"]
PIECES = [*CONTROLS, "<", "[", "\\", "\\\\", "|", "|>", "/s>", "INST]", " ", "a", "\n", "é"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(control in escaped for control in CONTROLS)


def rows():
    hot = [(5, k, "assistant" if k % 2 else "user", f"turn {k} </s>") for k in range(400)]
    return [
        (1, 0, "user", "hello <|end|> \\"),
        (1, 1, "assistant", "[INST] ok [/INST]"),
        (1, 1, "assistant", "[INST] ok [/INST]"),
        (2, 3, "assistant", None),
        (2, 1, None, "no role"),
        (2, 2, "<|text|>\n", ""),
        (None, None, "assistant", "x"),
        (None, 0, "assistant", "y" * 50_000),
        (3, 0, "assistant", ""),
        *[(6, 0, "user", f"{letter} tie") for letter in "dbeac"],
        *[(6, 0, "user", "z" * 70 + letter) for letter in "dbeac"],
        *hot,
    ]


def brute(rows):
    order = sorted(rows, key=lambda r: tuple((v is not None, v or "") if i > 1 else (v is not None, v or 0) for i, v in enumerate(r)))
    out = {}
    for conv, _, role, text in order:
        out.setdefault(conv, []).append((role or "", text or ""))
    found = {}
    for conv, turns in out.items():
        said = "".join(text for role, text in turns if role == "assistant")
        found[conv] = (
            len(turns),
            hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(said),
            hashlib.sha256(said.encode()).hexdigest(),
            sum(len(chat.TURN + chat.escape(r) + chat.TEXT + chat.escape(t) + chat.END) for r, t in turns),
        )
    return found


def test_digests_equal_brute_force(frame):
    turns = chat.assemble(frame(rows(), SCHEMA, partitions=5), RANKS)
    got = {r.conv_id: tuple(r)[1:] for r in chat.digests(turns, RANKS).collect()}
    assert got == brute(rows())


def test_places_are_prefix_sums_over_all_tasks(frame):
    turns = chat.assemble(frame(rows(), SCHEMA, partitions=5), RANKS).collect()
    of = {}
    for turn in turns:
        of.setdefault(turn.conv_id, []).append(turn)
        assert len(turn.ids) == len(turn.loss_mask)
    for parts in of.values():
        place = 0
        for number, turn in enumerate(sorted(parts, key=lambda t: t.turn_no)):
            assert (turn.turn_no, turn.first_token) == (number, place)
            place += len(turn.ids)


def test_mask_covers_the_assistant_text_only():
    codec = encoder(RANKS)
    marks = chat.reserved(codec.codec.max_token_value + 1)
    ids, mask = chat.assemble_turn("assistant", "yes </s>", codec.encode, marks)
    assert codec.codec.decode(ids[mask == 1].tolist()) == "yes <\\/s>"
    assert chat.read_turn(ids, codec, marks) == ("assistant", "yes </s>")
    assert not np.any(chat.assemble_turn("user", "yes", codec.encode, marks)[1])
    assert codec.codec.max_token_value < min(marks)


def test_other_columns_and_empty_tables(frame):
    docs = frame([(1, 0, "user", "a", "z")], f"{SCHEMA}, ids string")
    assert chat.digests(chat.assemble(docs, RANKS), RANKS).count() == 1
    assert chat.digests(chat.assemble(frame([], SCHEMA), RANKS), RANKS).count() == 0
