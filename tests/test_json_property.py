"""Property: a line is accepted iff it is exactly one JSON value (JS JSON.parse
rules), checked against Python's strict parser on generated batches."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tackroom.operators.clean import classify_lines

TEXT = st.text(st.characters(blacklist_categories=("Cs",)), max_size=8)
SCALAR = st.one_of(st.none(), st.booleans(), st.integers(-2**63, 2**63 - 1),
                   st.floats(allow_nan=False, allow_infinity=False), TEXT)
VALUE = st.recursive(SCALAR, lambda kids: st.one_of(st.lists(kids, max_size=4),
                                                     st.dictionaries(TEXT, kids, max_size=4)), max_leaves=12)
JUNK = st.sampled_from([" x", "]", "}", ",1", " {\"a\":1}", "],\"w\":[1", "}}", "\"", "'", ",", "  ", "\t"])


def _line(draw_value, mode, junk, ws):
    text = json.dumps(draw_value, ensure_ascii=False)
    if mode == "plain":
        return ws + text + ws
    if mode == "suffix":
        return text + junk
    if mode == "prefix":
        return junk + text
    return text[: max(1, len(text) // 2)]  # truncated


LINE = st.builds(_line, VALUE, st.sampled_from(["plain", "suffix", "prefix", "cut"]), JUNK,
                 st.sampled_from(["", " ", "\t", "\r"]))


def strict_ok(line: str) -> bool:
    def reject(_):
        raise ValueError("constant")
    try:
        json.loads(line, parse_constant=reject)
        return True
    except ValueError:
        return False


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.too_slow, HealthCheck.data_too_large])
@given(st.lists(LINE, min_size=40, max_size=80))
def test_strict_parse_matches_strict_json(spark, lines):
    lines = [ln for ln in lines if ln.strip(" \t\r\n")]  # blank lines are a class of their own
    df = spark.createDataFrame([(i, ln) for i, ln in enumerate(lines)], "line_no long, line string")
    got = {r.line_no: r.status != "malformed" for r in classify_lines(df, ["line_no"]).collect()}
    wrong = [(ln, got[i]) for i, ln in enumerate(lines) if got[i] != strict_ok(ln)]
    assert not wrong, wrong[:5]
