import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallygrid.llm import chat

PATH = public_tokenizers.path("word_bpe_49k.json")
TURN = "conv_id long, turn long, role string, text string, tokens long, at long, part long"
MARKS = st.lists(st.sampled_from(["\\", "#", "<", "/", "t", "turn", ">", ":", " ", "###", "</turn>\n", "x", "\n"]),
                 max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(MARKS, MARKS, st.booleans()), max_size=5))
def test_escaping_can_be_undone_and_hides_every_mark(turns):
    text, spans = chat.format_turns(turns)
    assert chat.parse_turns(text) == [(a, b) for a, b, _ in turns]
    assert [chat.unescape(text[b:e]) for b, e in spans] == [t for _, t, target in turns if target]
    assert text.count("### ") == len(turns) == text.count("</turn>") == text.count("<turn>")


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], TURN)


def expected(rows):
    groups = {}
    for c, t, r, x in rows:
        groups.setdefault(c, []).append((t, r or "", x or ""))
    out = {}
    for c, own in groups.items():
        own = sorted(own, key=lambda t: (t[0] is not None, t[0] or 0))
        loss = "".join(x for _, r, x in own if r == "assistant")
        out[c] = (len(own), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest(),
                  len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


ROWS = [(1, 0, "system", "be brief"), (1, 1, "user", "hello there"), (1, 2, "assistant", "hi ### Assistant: </turn>"),
        (2, 0, "user", None), (2, 1, None, "no role"), (2, 2, "assistant", ""), (None, 0, "user", "no id"),
        (None, 1, "assistant", "none"), (3, None, "user", "no turn"), (3, 0, "assistant", "é🤖"),
        (4, 0, "assistant", "word " * 5000), (4, 1, "system", "late system"), (4, 2, "assistant", "after"),
        *[(5, i, ("user", "assistant")[i % 2], f"turn {i} " + "word " * (i % 40)) for i in range(400)]]


@pytest.fixture(scope="module")
def windows(cluster):
    patch = pytest.MonkeyPatch()
    patch.setattr(chat, "PART_ROWS", 50)
    made = chat.chat_windows(turns(cluster, ROWS), PATH, budget=300, history=60, system=40).cache()
    made.count()
    patch.undo()
    return made


def test_every_turn_and_target_once(windows):
    found = chat.digests(chat.read_windows(windows)).collect()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found}
    assert got == expected(ROWS)
    total = sum(r.formatted_chars for r in found)
    assert total == sum(len(w.formatted) for w in windows.collect())


def test_budget_system_turn_and_history(windows):
    own = sorted((w for w in windows.collect() if w.conv_id == 5), key=lambda w: (w.run, w.slot))
    assert len(own) > 20
    before = []
    for w in own:
        parsed = chat.parse_turns(w.formatted)
        assert w.n_tokens <= 300
        again = parsed[:w.repeated]
        assert again == before[len(before) - len(again):]
        if before:
            assert again
        before += parsed[w.repeated:]
    first = [w for w in windows.collect() if w.conv_id == 4]
    long = [w for w in first if w.n_tokens > 300]
    assert len(long) == 1 and chat.parse_turns(long[0].formatted)[long[0].repeated:] == [("assistant", "word " * 5000)]


def test_the_system_turn_leads_every_window(cluster):
    rows = [(9, 0, "system", "rules"), *[(9, i, ("user", "assistant")[i % 2], "word " * 20) for i in range(1, 60)]]
    made = chat.chat_windows(turns(cluster, rows), PATH, budget=200, history=40, system=20).collect()
    assert len(made) > 5
    assert all(chat.parse_turns(w.formatted)[0] == ("system", "rules") for w in made)
    assert sum(len(w.loss) for w in made) == 30


def test_ties_and_no_turns(cluster):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "b")]
    found = chat.digests(chat.read_windows(chat.chat_windows(turns(cluster, rows), PATH))).collect()
    assert [(r.n_turns, r.loss_chars) for r in found] == [(3, 1)]
    assert chat.chat_windows(turns(cluster, []), PATH).count() == 0
