import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appendlake.operators import ledger
from appendlake.plans import loading
from appendlake.sinks import RunFolderSink, VersionedSink
from appendlake.sinks.versions import current, current_run_folders
from appendlake.sources import growing
from appendlake.sources.growing import GrowingReader, Plans
from appendlake.streaming import growth
from appendlake.streaming.growth import load_growth, stream_growth

SCHEMA = T.StructType([T.StructField("Id", T.StringType()), T.StructField("versionnumber", T.LongType()), T.StructField("note", T.StringType())])


def text(ids, note="n"):
    return "".join(f'id{i},1,"{note}\n""{i}"""\n' for i in ids)


def found(rows):
    return sorted((r.Id, r.note.split('"')[1]) for r in rows.collect())


def expected(ids):
    return sorted((f"id{i}", str(i)) for i in ids)


@pytest.fixture
def state(tmp_path):
    return str(tmp_path / "state")


def read_all(reader, start, end):
    batches = [b for p in reader.partitions(start, end) for b in reader.read(p)]
    return [r for b in batches for r in b.column(0).to_pylist()]


def reader_of(lake, state, **limits):
    return GrowingReader({"root": f"{lake.source_root}/acc", "state": state} | {k: str(v) for k, v in limits.items()})


@pytest.mark.parametrize("limits", [{}, {"file_bytes": 7}, {"batch_bytes": 11}, {"batch_bytes": 1}])
def test_every_record_once_whatever_the_steps(lake, put, state, limits):
    whole = text(range(12), "a, long\nnote") + 'x,1,5" wide\n'
    read, at = [], {"plan": 0}
    for i in range(0, len(whole), 37):
        put("acc", "p.csv", whole[i : i + 37])
        put("acc", "q.csv", f"q{i},1,y\n")
        while True:
            reader = reader_of(lake, state, **limits)  # as after a restart
            end = reader.latestOffset()
            if end == at:
                break
            rows = read_all(reader, at, end)
            assert read_all(reader_of(lake, state, **limits), at, end) == rows  # run again
            reader.commit(end)
            read, at = read + rows, end
    own = [r for r in read if not r.startswith("q")]
    assert "\n".join(own) + "\n" == whole
    assert sorted(r for r in read if r.startswith("q")) == sorted(f"q{i},1,y" for i in range(0, len(whole), 37))
    # Notes of committed batches are gone but for the last of each file.
    assert len(os.listdir(f"{state}/ends")) == 2


def test_a_lost_note_is_found_again(lake, put, state):
    put("acc", "p.csv", text(range(3)) + 'id3,1,"half\n')
    reader = reader_of(lake, state)
    first = reader.latestOffset()
    assert len(read_all(reader, {"plan": 0}, first)) == 3
    put("acc", "p.csv", 'way"\n' + text([4]))
    for name in os.listdir(f"{state}/ends"):
        os.remove(f"{state}/ends/{name}")
    reader = reader_of(lake, state)
    assert read_all(reader, first, reader.latestOffset()) == ['id3,1,"half\nway"', text([4])[:-1]]


def test_plans_are_restored_from_their_last_map(lake, put, state, monkeypatch):
    monkeypatch.setattr(growing, "SNAPSHOT_EVERY", 3)
    for i in range(8):
        put("acc", f"p{i % 3}.csv", f"{i}\n" * (i + 1))
        reader_of(lake, state).latestOffset()
    plans = Plans(state)
    assert plans.last == 8 and sorted(n for n in os.listdir(f"{state}/plans") if n.startswith("map")) == [f"map-{i:012d}" for i in (3, 6)]
    sizes = {f"{lake.source_root}/acc/p{i}.csv": os.path.getsize(f"{lake.source_root}/acc/p{i}.csv") for i in range(3)}
    assert plans.known == sizes
    # Nothing new, a shrunk file and a missing folder plan nothing.
    open(f"{lake.source_root}/acc/p0.csv", "w").close()
    assert reader_of(lake, state).latestOffset() == {"plan": 8}
    assert GrowingReader({"root": f"{lake.source_root}/none", "state": state + "2"}).latestOffset() == {"plan": 0}


def test_two_growth_steps(spark, lake, put, state):
    sink = VersionedSink(lake)
    put("acc", "p.csv", text(range(3)) + "id3,1")
    assert load_growth(spark, lake, "acc", SCHEMA, sink, state, batch_bytes=10_000) == 1
    assert found(current(spark, lake, "acc")) == expected(range(3))
    put("acc", "p.csv", ',"n\n""3"""\n')
    put("acc", "q.csv", text([4]))
    assert load_growth(spark, lake, "acc", SCHEMA, sink, state) == 1
    # The second run read the new bytes only.
    assert [r.rows_in for r in ledger.log(spark, lake.loads).orderBy("number").collect()] == [3, 2]
    assert found(current(spark, lake, "acc")) == expected(range(5))
    assert load_growth(spark, lake, "acc", SCHEMA, sink, state) == 0
    row = current(spark, lake, "acc").first()
    assert row["_file_path"].endswith(".csv") and isinstance(row["_partition_modification_time"], dt.datetime)
    put("acc", "p.csv", text([1], "m"))
    load_growth(spark, lake, "acc", SCHEMA, sink, state, mode="upsert")
    rows = current(spark, lake, "acc")
    assert rows.count() == 5 and rows.where(F.col("Id") == "id1").first().note.startswith("m")
    with pytest.raises(ValueError, match="full"):
        stream_growth(spark, lake, "acc", SCHEMA, sink, state, mode="full")


def test_capped_batches(spark, lake, put, state):
    put("acc", "p.csv", text(range(20)))
    assert load_growth(spark, lake, "acc", SCHEMA, RunFolderSink(lake), state, batch_bytes=150) > 1
    assert found(current_run_folders(spark, lake, "acc")) == expected(range(20))


def test_one_start_runs_all_batches(spark, lake, put, state, monkeypatch):
    put("acc", "p.csv", text(range(20)))
    starts, start = [], growth.stream_growth
    monkeypatch.setattr(growth, "stream_growth", lambda *args, **options: starts.append(0) or start(*args, **options))
    batches = load_growth(spark, lake, "acc", SCHEMA, RunFolderSink(lake), state, batch_bytes=150)
    assert batches == ledger.log(spark, lake.loads).count() > 1
    assert len(starts) == 1
    assert found(current_run_folders(spark, lake, "acc")) == expected(range(20))
    put("acc", "p.csv", text([20]))
    assert load_growth(spark, lake, "acc", SCHEMA, RunFolderSink(lake), state, batch_bytes=150) == 1
    assert found(current_run_folders(spark, lake, "acc")) == expected(range(21))


@pytest.mark.parametrize("after_the_log", [True, False])
def test_a_death_inside_a_batch_adds_no_row_twice(spark, lake, put, state, monkeypatch, after_the_log):
    sink, load = RunFolderSink(lake), loading.load_rows
    put("acc", "p.csv", text(range(3)))

    def die(*args, **options):
        if after_the_log:
            load(*args, **options)
        raise RuntimeError("lost")

    monkeypatch.setattr(growth, "load_rows", die)
    with pytest.raises(Exception, match="lost"):
        stream_growth(spark, lake, "acc", SCHEMA, sink, state).awaitTermination()
    monkeypatch.setattr(growth, "load_rows", load)
    put("acc", "p.csv", text(range(3, 5)))
    load_growth(spark, lake, "acc", SCHEMA, sink, state)
    assert found(current_run_folders(spark, lake, "acc")) == expected(range(5))
    assert [r.rows_in for r in ledger.log(spark, lake.loads).orderBy("number").collect()] == [3, 2]


def test_malformed_rows_are_counted(spark, lake, put, state):
    put("acc", "p.csv", "id1,1,n\nid2,x,n\nid3\n")
    load_growth(spark, lake, "acc", SCHEMA, RunFolderSink(lake), state)
    log = ledger.log(spark, lake.loads).first()
    assert (log.rows_in, log.rows_bad) == (3, 2)
