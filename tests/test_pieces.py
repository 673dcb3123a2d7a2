import csv
import io
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from appendlake.sources import pieces, records

RANGE = "source_path string, range_start bigint, range_end bigint"


def random_csv(rng, rows):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
    for _ in range(rows):
        writer.writerow(
            "".join(rng.choices('ab",\n é', k=rng.choice([0, 1, 3, 30]))) for _ in range(rng.randint(1, 4))
        )
    return out.getvalue().encode()


def walk(data, state="start"):
    """Offsets after each record and the state at the end, one byte at a time."""
    found = []
    for i, byte in enumerate(data):
        c = chr(byte)
        if state == "quoted":
            state = "quote" if c == '"' else "quoted"
        elif state == "quote" and c == '"':
            state = "quoted"
        elif state == "start" and c == '"':
            state = "quoted"
        elif c == "\n":
            found.append(i + 1)
            state = "start"
        else:
            state = "start" if c == "," else "plain"
    return found, state


def ends_of(data):
    return walk(data)[0]


def write_all(tmp_path, blobs):
    rows = []
    for i, blob in enumerate(blobs):
        path = tmp_path / f"f{i}.csv"
        path.write_bytes(blob)
        rows.append((str(path), 0, len(blob)))
    return rows


@pytest.mark.parametrize("chunk_bytes", [1, 7, 64])
def test_pieces_begin_and_end_at_record_ends(spark, tmp_path, chunk_bytes):
    rng = random.Random(chunk_bytes)
    blobs = [random_csv(rng, rng.randint(1, 25)) for _ in range(40)]
    rows = write_all(tmp_path, blobs)
    found = pieces.cut(spark.createDataFrame(rows, RANGE), chunk_bytes, block_bytes=5, chunks_known=8).collect()
    for (path, _, size), blob in zip(rows, blobs):
        own = sorted((r.piece_start, r.piece_end) for r in found if r.source_path == path)
        assert all(r.error is None for r in found if r.source_path == path)
        assert own[0][0] == 0 and own[-1][1] == size
        assert all(a[1] == b[0] for a, b in zip(own, own[1:]))
        assert {end for _, end in own[:-1]} <= set(ends_of(blob))


def test_an_unfinished_record_is_left_out_or_kept(spark, tmp_path):
    done = b'1,"a\nb"\n2,c\n'
    rows = write_all(tmp_path, [done + b'3,"half\nof', done + b"3,half", b'"never ended\n', done])
    ranges = spark.createDataFrame(rows, RANGE)

    def last_ends(keep_tail):
        ends = {}
        for r in pieces.cut(ranges, 4, keep_tail=keep_tail).collect():
            ends[r.source_path] = max(ends.get(r.source_path, 0), r.piece_end)
        return [ends.get(path) for path, _, _ in rows]

    assert last_ends(False) == [len(done), len(done), None, len(done)]
    assert last_ends(True) == [size for _, _, size in rows]


@pytest.mark.parametrize(
    "text",
    [b'1,a"b,x\n2,"c\nd",y\n3,e"f,z\n', b'1,"a"b,x\n2,c,y\n', b'1, "a",x\n2,b,y\n', b'1,a"\n2,"b"\n', b'1,5" pipe\n2,"line one\nline two"\n3,x\n'],
)
def test_stray_quotes(spark, tmp_path, text):
    path = write_all(tmp_path, [text])[0][0]
    schema = T.DataType.fromDDL("a bigint, b string, c string")
    whole = sorted(map(repr, records.read(spark, [path], schema, False).collect()))
    for chunk_bytes in (1, 3, 1000):
        split = records.read_split(spark, [path], schema, chunk_bytes=chunk_bytes)
        assert sorted(map(repr, split.collect())) == whole


def test_cuts_of_any_bytes(spark, tmp_path):
    """Quotes anywhere: pieces end at the record ends that one pass over the bytes finds."""
    rng = random.Random(9)
    blobs = ["".join(rng.choices('a",\n', weights=[4, 3, 2, 2], k=rng.randint(1, 120))).encode() for _ in range(150)]
    rows = write_all(tmp_path, blobs)
    for chunk_bytes in (1, 5):
        found = pieces.cut(spark.createDataFrame(rows, RANGE), chunk_bytes, block_bytes=3, keep_tail=False, chunks_known=8).collect()
        for (path, _, _), blob in zip(rows, blobs):
            own = sorted((r.piece_start, r.piece_end) for r in found if r.source_path == path)
            ends = ends_of(blob)
            assert [e for _, e in own][-1:] == ends[-1:]
            assert {e for _, e in own} <= set(ends) and (not own or own[0][0] == 0)
            if chunk_bytes == 1:
                assert len(own) >= len(ends) - 1


def test_an_unreadable_range_is_an_error_or_a_row(spark, tmp_path):
    rows = write_all(tmp_path, [b"1,a\n2,b\n"]) + [(str(tmp_path / "none.csv"), 0, 10)]
    ranges = spark.createDataFrame(rows, RANGE)
    kept = {r.source_path: r for r in pieces.cut(ranges, 100, keep_errors=True).collect()}
    assert kept[rows[0][0]].error is None
    assert "none.csv" in kept[rows[1][0]].error
    with pytest.raises(Exception, match="none.csv"):
        pieces.cut(ranges, 100).collect()


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 9), st.integers(0, 30), st.integers(1, 40))
def test_chunk_summary_agrees_with_a_byte_loop(tmp_path_factory, seed, block, start, length):
    data = random_csv(random.Random(seed), 6)
    start = min(start, len(data) - 1)
    end = min(start + length, len(data))
    path = tmp_path_factory.getbasetemp() / "summary.csv"
    path.write_bytes(data)
    got = pieces.summarize_chunk(str(path), start, end, 0, len(data), block)
    # A run of quotes belongs to the chunk where it starts; the case is that behind it.
    at = start
    while data[start - 1 : start] == b'"' and data[at : at + 1] == b'"':
        at += 1
    case = int(walk(data[:at])[1] == "quoted")
    inside = [e for e in ends_of(data) if start < e <= end]
    assert list(got[2 * case : 2 * case + 2]) == ([inside[0], inside[-1]] if inside else [None, None])
    following = walk(data[:end])[1]
    if following != "quote" and data[end - 1 : end] != b'"':
        assert got[4 + case] == (following == "quoted")


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 50))
def test_records_of_a_piece(tmp_path_factory, seed, batch):
    rng = random.Random(seed)
    data = random_csv(rng, 8) + rng.choice([b"", b"\n", b'last,"one\n"'])
    path = tmp_path_factory.getbasetemp() / "records.csv"
    path.write_bytes(data)
    got = [r for a in pieces.piece_records(str(path), 0, len(data), batch) for r in a.to_pylist()]
    bounds = [0, *ends_of(data)]
    if bounds[-1] < len(data):
        bounds.append(len(data))
    parts = [data[a:b].decode() for a, b in zip(bounds, bounds[1:])]
    parts = [p[:-1].removesuffix("\r") if p.endswith("\n") and i + 2 <= len(bounds) and bounds[i + 1] in ends_of(data) else p
             for i, p in enumerate(parts)]
    assert got == [p for p in parts if p]


def test_split_reader_reads_what_the_whole_file_reader_reads(spark, tmp_path):
    rng = random.Random(3)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    for i in range(400):
        writer.writerow([i, "".join(rng.choices('xy",\n ü', k=rng.randint(0, 60))), rng.choice(["", "1.5", "bad"])])
    (tmp_path / "a.csv").write_bytes(out.getvalue().encode())
    schema = T.DataType.fromDDL("id bigint, text string, score double")
    whole = records.read(spark, [str(tmp_path / "a.csv")], schema)
    split = records.read_split(spark, [str(tmp_path / "a.csv")], schema, chunk_bytes=97, file_columns=True)
    assert split.schema.names == whole.schema.names
    assert sorted(map(repr, split.collect())) == sorted(map(repr, whole.collect()))
    assert whole.count() == 400


def test_marks_of_short_blocks():
    for size in range(1, 20):
        block = bytes(random.Random(size).choices(b'"\nab', k=size))
        data, quotes, ends = pieces._marks(block)
        assert quotes.tolist() == np.flatnonzero(data == pieces.QUOTE).tolist()
        assert ends.tolist() == np.flatnonzero(data == pieces.NEWLINE).tolist()
