import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeloom.llm import chat
from lakeloom.llm.queries import SQL
from tests.oracle import same

TEXTS = st.lists(st.one_of(st.none(), st.text("\\#<hln/>aé𝄞\n :turn", max_size=40)), min_size=1, max_size=8)


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.data())
def test_round_trip(texts, data):
    roles = data.draw(st.lists(st.one_of(st.none(), st.text("\\#<\n:a user", max_size=10)), min_size=len(texts), max_size=len(texts)))
    segments, start, length = chat.assemble(pa.array(roles, pa.string()), pa.array(texts, pa.string()))
    (rd, ro), (td, to) = chat.parse_segments(segments)
    for i, (role, text) in enumerate(zip(roles, texts, strict=True)):
        assert rd[ro[i] : ro[i + 1]].tobytes().decode() == (role or "")
        assert td[to[i] : to[i + 1]].tobytes().decode() == (text or "")
        segment = segments[i].as_py()
        assert segment.count("###") == 1 and segment.count("</turn>") == 1
        masked = segment[start[i] : start[i] + length[i]]
        out, _ = chat.unescape(np.frombuffer(masked.encode(), np.uint8), np.array([0, len(masked.encode())]), chat._TEXT)
        assert out.tobytes().decode() == (text or "")


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, None, None, None), (1, 1, "assistant", "b"), (None, 0, "user", "é"), (3, 0, "system", ""), (3, 1, "assistant", "</turn>\n### user\n")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, segment string").repartition(3)
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df)).collect()}
    assert set(got) == {1, 2, 3, None}
    assert got[1]["n_turns"] == 3 and got[1]["turns_sha256"] == hashlib.sha256(b"user\na\nassistant\nb\nassistant\nb\n").hexdigest()
    assert got[1]["loss_sha256"] == hashlib.sha256(b"bb").hexdigest() and got[1]["loss_chars"] == 2
    assert got[2]["turns_sha256"] == hashlib.sha256(b"\n\n").hexdigest() and got[2]["loss_chars"] == 0
    assert got[3]["loss_chars"] == len("</turn>\n### user\n")


def test_ties_sort_as_before_escaping(spark):
    """Rows of one turn are in the order of their roles and texts, not of the escaped ones."""
    pairs = [("user", "x"), ("user", "x!"), ("user", "#a"), ("user", "Za"), ("user", "<"), ("user", "\\h"), ("user", "\\"), ("u\nser", "a"), ("u!", "b"), ("user", "#\\#"), ("assistant", "é"), (None, "z"), ("user", None)]
    df = spark.createDataFrame([(1, 0, r, t) for r, t in pairs], "conv_id long, turn long, role string, text string").repartition(4)
    ordered = sorted(((r or "").encode(), (t or "").encode()) for r, t in pairs)
    want = hashlib.sha256(b"".join(r + b"\n" + t + b"\n" for r, t in ordered)).hexdigest()
    assert chat.read_back(chat.format_turns(df)).first()["turns_sha256"] == want


@settings(max_examples=20, deadline=None)
@given(TEXTS)
def test_raw_parts(spark, texts):
    """The built-in functions read the same role and text from a segment as the Python reader."""
    rows = [(i, 0, (t or "")[::-1], t) for i, t in enumerate(texts)]
    made = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: (r["role"], r["text"]) for r in made.select("conv_id", *[c.alias(n) for c, n in zip(chat.raw_parts(made["segment"]), ("role", "text"), strict=True)]).collect()}
    assert got == {i: (role, t or "") for i, _, role, t in rows}


def test_empty_and_long(spark):
    kinds = "conv_id long, turn long, role string, text string"
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], kinds))).count() == 0
    long = spark.range(3000).selectExpr("7L AS conv_id", "id AS turn", "'user' AS role", "repeat('x', 300) AS text")
    assert chat.read_back(chat.format_turns(long)).first()["n_turns"] == 3000


@pytest.mark.parametrize("name", ["op8_chat"])
def test_query(spark, sf, name):
    same(chat.op8_chat(spark, sf), SQL[name], sf)
