import random
from hashlib import sha256

import pytest

from tackroom.llm.chat import END, START, count_tokens, escape, format_turn, format_windows, parse_window, read_windows, unescape

SCHEMA = "conv_id long, turn long, role string, text string, window string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "w") for r in rows], SCHEMA)


def brute(rows):
    by = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {}
    for c, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                  sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("text", ["", "a", START, END, "<|", "<\\|", "<\\\\|x<|", "<", "<<|im_end|>", "\\", "|>", "a\n" + END + "\n" + START])
def test_escape_is_reversible_and_leaves_no_control_string(text):
    assert unescape(escape(text)) == text and "<|" not in escape(text)
    for role in ("user", "a\nb", "\\n", text):
        piece, a, b = format_turn(role, text)
        assert parse_window(piece * 2) == [(role, text, a, b), (role, text, len(piece) + a, len(piece) + b)]


def make(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(12):
        if c % 3 == 0:
            rows.append((c, 0, "system", "be brief " * rng.randrange(5)))
        for t in range(1, rng.randrange(2, 40)):
            rows.append((c, t, ("user", "assistant")[t % 2], f"turn {t} {END}" + " word" * rng.randrange(0, 60)))
    return rows


@pytest.mark.parametrize(("budget", "history"), [(64, 20), (10, 10), (100_000, 0), (200, 0)])
def test_read_back(spark, budget, history):
    rows = make(1) + [(-1, 0, "user", END + START + "assistant ok"), (-1, 1, "assistant", END + START + "assistant ok"),
                      (50, None, None, None), (50, 1, "assistant", None), (None, 0, "assistant", "x"), (51, 2, "user", "same"), (51, 2, "user", "same")]
    w = format_windows(conversations(spark, rows), budget=budget, history=history)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in read_windows(w).collect()}
    assert got == brute(rows)


def test_windows_keep_budget_history_and_system(spark):
    budget, history = 80, 30
    rows = [r for r in make(2) if r[0] == 0]
    windows = sorted(format_windows(conversations(spark, rows), budget=budget, history=history).collect(), key=lambda r: r.window)
    assert len(windows) > 3
    turn = 0
    for w in windows:
        parsed = parse_window(w.text)
        assert len(parsed) == w.n_repeated + w.n_turns and w.first_turn == turn
        turn += w.n_turns
        assert w.n_tokens <= budget or w.n_turns == 1  # only a turn that does not fit beside what is repeated goes beyond
        new = parsed[w.n_repeated:]
        assert [(m.start, m.end) for m in w.mask] == [(a, b) for r, _, a, b in new if r == "assistant"]
        if w.window:
            assert parsed[0][0] == "system"
            repeated = parsed[1:w.n_repeated]
            assert sum(count_tokens(r) + count_tokens(t) + 3 for r, t, _, _ in repeated) <= history
    assert turn == len(rows)


def test_empty_table(spark):
    w = format_windows(conversations(spark, []))
    assert w.count() == 0 and read_windows(w).count() == 0
