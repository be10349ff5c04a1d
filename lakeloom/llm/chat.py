"""Chat formatting by columnar byte assembly.

A turn becomes ``### <role>\\n<text></turn>\\n``. Inside roles and texts the bytes that could form a
control string are escaped: ``\\`` as ``\\\\``, ``#`` as ``\\h``, ``<`` as ``\\l``, and in roles a line
end as ``\\n``; so neither ``###`` nor ``</turn>`` can occur in them, and the escapes reverse.
For each batch the segment lengths, cumulative offsets and scatter indices are computed in numpy,
and headers and contents are copied into one preallocated buffer that becomes the Arrow column.

Turns are formatted one by one, wherever they lie, so a conversation of any length spreads over
all tasks. Reading back streams through the turns sorted by conversation with one running digest.

A digest runs over a conversation's turns in order, so one conversation is read back by one task, which
streams through it with a constant state; only conversations, not turns, spread here.

Nulls and edge cases: a NULL text or role is the empty text; turns sort by (turn, role, text), as they
were before escaping, NULL turn first, so ties and repeated rows have one order and all count; a NULL
conv_id is one conversation; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .textkit import buffers, slices

HEAD, HEAD_END, TURN_END = b"### ", b"\n", b"</turn>\n"
TAUGHT = "assistant"
_CODES = {ord("\\"): ord("\\"), ord("#"): ord("h"), ord("<"): ord("l")}
_ROLE_CODES = _CODES | {ord("\n"): ord("n")}


def _tables(codes: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    code, back = np.zeros(256, np.uint8), np.arange(256, dtype=np.uint8)
    for byte, c in codes.items():
        code[byte], back[c] = c, byte
    return code, back


_TEXT, _ROLE = _tables(_CODES), _tables(_ROLE_CODES)


def escape(data: np.ndarray, offsets: np.ndarray, tables: tuple) -> tuple[np.ndarray, np.ndarray]:
    code = tables[0][data]
    special = code > 0
    grown = np.zeros(len(data) + 1, np.int64)
    np.cumsum(1 + special, out=grown[1:])
    out = np.empty(grown[-1], np.uint8)
    at = grown[:-1]
    out[at] = np.where(special, ord("\\"), data)
    out[at[special] + 1] = code[special]
    return out, grown[offsets]


def unescape(data: np.ndarray, offsets: np.ndarray, tables: tuple) -> tuple[np.ndarray, np.ndarray]:
    """The reverse. In a run of backslashes every second one, from the first, starts an escape."""
    slash = data == ord("\\")
    at = np.flatnonzero(slash)
    first = np.ones(len(at), bool)
    first[1:] = np.diff(at) > 1
    # a run never crosses texts: an escape is whole within its own text, so parity restarts there too
    first |= np.isin(at, offsets)
    runs = np.flatnonzero(first)
    within = np.arange(len(at)) - np.repeat(runs, np.diff(np.append(runs, len(at))))
    starts = at[within % 2 == 0]
    out = data.copy()
    out[starts + 1] = tables[1][data[starts + 1]]
    keep = np.ones(len(data), bool)
    keep[starts] = False
    left = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=left[1:])
    return out[keep], left[offsets]


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[i] .. starts[i] + lengths[i] - 1 of all i, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points of each text."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return np.diff(total[offsets])


def assemble(role: pa.Array, text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Segments of a batch of turns, and where each content starts and how long it is, in code points."""
    rd, ro = escape(*buffers(role), _ROLE)
    td, to = escape(*buffers(text), _TEXT)
    n, rl, tl = len(role), np.diff(ro), np.diff(to)
    fixed = len(HEAD) + len(HEAD_END) + len(TURN_END)
    offsets = np.zeros(n + 1, np.int64)
    np.cumsum(rl + tl + fixed, out=offsets[1:])
    out, at = np.empty(offsets[-1], np.uint8), offsets[:-1]
    role_at = at + len(HEAD)
    text_at = role_at + rl + len(HEAD_END)
    for bytes_, where in ((HEAD, at), (HEAD_END, role_at + rl), (TURN_END, text_at + tl)):
        for i, b in enumerate(bytes_):
            out[where + i] = b
    out[_ragged(role_at, rl)] = rd
    out[_ragged(text_at, tl)] = td
    segments = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(out)])
    start = len(HEAD) + len(HEAD_END) + _points(rd, ro)
    return segments, start, _points(td, to)


def format_turns(turns: DataFrame, taught: str = TAUGHT) -> DataFrame:
    """conv_id, turn, segment, loss_start, loss_length: the loss mask of a segment in its code points, NULL where nothing is taught."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                segment, start, length = assemble(b.column("role"), b.column("text"))
                other = ~np.array([r == taught for r in b.column("role").to_pylist()], bool)
                yield pa.RecordBatch.from_arrays(
                    [b.column("conv_id"), b.column("turn"), segment.cast(pa.string()), pa.array(start, mask=other), pa.array(length, mask=other)],
                    ["conv_id", "turn", "segment", "loss_start", "loss_length"],
                )

    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").mapInArrow(run, "conv_id long, turn long, segment string, loss_start long, loss_length long")


def parse_segments(segments: pa.Array) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Roles and texts, each as bytes and offsets, read back from formatted segments."""
    data, offsets = buffers(segments)
    at, end = offsets[:-1], offsets[1:]
    lines = np.flatnonzero(data == HEAD_END[0])
    head_end = lines[np.searchsorted(lines, at)] if len(at) else at
    pieces = []
    for start, stop, tables in ((at + len(HEAD), head_end, _ROLE), (head_end + len(HEAD_END), end - len(TURN_END), _TEXT)):
        own = np.zeros(len(at) + 1, np.int64)
        np.cumsum(stop - start, out=own[1:])
        pieces.append(unescape(data[_ragged(start, stop - start)], own, tables))
    return pieces[0], pieces[1]


def _plain(escaped: Column, codes: dict[int, int]) -> Column:
    """The text before escaping, in built-in functions: each pair of backslashes parts it, what is left has single ones only."""

    def part(x: Column) -> Column:
        for byte, code in codes.items():
            if byte != ord("\\"):
                x = F.replace(x, F.lit(f"\\{chr(code)}"), F.lit(chr(byte)))
        return x

    return F.array_join(F.transform(F.split(escaped, "\\\\\\\\"), part), "\\")


def raw_parts(segment: Column) -> tuple[Column, Column]:
    """Role and text of a formatted segment."""
    head = F.locate(HEAD_END.decode(), segment)
    role = F.substring(segment, F.lit(len(HEAD) + 1), head - F.lit(len(HEAD) + 1))
    text = F.substring(segment, head + 1, F.char_length(segment) - head - F.lit(len(TURN_END)))
    return _plain(role, _ROLE_CODES), _plain(text, _CODES)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from segments and masks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        now, done = None, []

        def flush(most: int) -> Iterator[pa.RecordBatch]:
            if len(done) > most:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate(types)], names)
                done.clear()

        def close() -> None:
            done.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]))

        for whole in batches:
            for b in slices(whole, "segment"):
                (rd, ro), (td, to) = parse_segments(b.column("segment"))
                rb, tb = rd.tobytes(), td.tobytes()
                data, offsets = buffers(b.column("segment"))
                points, sizes = _points(td, to), _points(data, offsets)
                masked = b.column("loss_start").is_valid().to_pylist()
                for i, conv in enumerate(b.column("conv_id").to_pylist()):
                    if now is None or now[0] != conv:
                        if now is not None:
                            close()
                        now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    text = tb[to[i] : to[i + 1]]
                    now[1] += 1
                    now[2].update(rb[ro[i] : ro[i + 1]] + b"\n" + text + b"\n")
                    if masked[i]:
                        now[3] += int(points[i])
                        now[4].update(text)
                    now[5] += int(sizes[i])
                yield from flush(5000)
        if now is not None:
            close()
        yield from flush(0)

    # segments don't sort as the texts do, since '#', '<' and line ends are escaped: ties are settled by what was escaped
    role, text = raw_parts(F.col("segment"))
    dealt = formatted.repartition("conv_id").withColumns({"_role": role, "_text": text})
    ordered = dealt.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "_role", "_text").drop("_role", "_text")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: Rows that put the control strings into the texts themselves.
HOSTILE = ((-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    hostile = spark.createDataFrame([*HOSTILE], "conv_id long, turn long, role string, text string")
    return read_back(format_turns(turns.unionByName(hostile)))


SQL = {
    "op8_chat": """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok')),
e AS (SELECT *, 13 + length(role) + length(text) + len(regexp_extract_all(role, '[\\\\#<\\n]')) + len(regexp_extract_all(text, '[\\\\#<]')) AS chars FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""
}
