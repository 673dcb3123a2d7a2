import dataclasses
import datetime as dt
import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appendlake.operators import ledger
from appendlake.plans import loading
from appendlake.plans.copying import copy_growth
from appendlake.plans.loading import load_entities, load_entity
from appendlake.sinks import CatalogTableSink, RunFolderSink, VersionedSink
from appendlake.sources import records
from appendlake.sources.files import literal
from appendlake.sinks.versions import current, current_run_folders, live_runs
from appendlake.streaming.loads import stream_load

SCHEMA = T.StructType(
    [
        T.StructField("Id", T.StringType()),
        T.StructField("versionnumber", T.LongType()),
        T.StructField("SinkCreatedOn", T.TimestampType()),
        T.StructField("name", T.StringType()),
        T.StructField("statecode", T.LongType()),
    ]
)
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def text(ids, name="n", year=2024, version=1):
    return "".join(f'id{i},{version},"1/5/{year} 3:04:05 PM","{name}\n{i}",{i % 2}\n' for i in ids)


@pytest.fixture
def step(spark, lake, put):
    """Append text to the entity's file, copy it and load it; one minute later each time."""
    clock = [START]

    def run(body, sink, mode="append", schema=SCHEMA, **options):
        clock[0] += dt.timedelta(minutes=1)
        if body:
            put("acc", "p.csv", body)
        copy_growth(spark, lake, ["acc"], run_ts=clock[0])
        return load_entity(spark, lake, "acc", schema, sink, mode, run_ts=clock[0], **options)

    return run


def names(rows):
    return sorted((r.Id, r.name.replace("\n", "")) for r in rows.collect())


def expected(*groups):
    return sorted((f"id{i}", f"{name}{i}") for ids, name in groups for i in ids)


def test_run_folders(spark, lake, step):
    sink = RunFolderSink(lake)
    log = step(text(range(4)), sink).first()
    assert log.place.endswith("/tables/acc/acc_20240101_000100_000001.parquet")
    assert (log.kind, log.rows_in, log.rows_bad) == ("PATH", 4, 0)
    step(text(range(4, 6)), sink)
    rows = current_run_folders(spark, lake, "acc")
    assert names(rows) == expected((range(6), "n"))
    assert rows.columns[-2:] == ["_partition_modification_time", "_file_path"]
    # Nothing new: no row in the log, and the schema given was not changed.
    assert step("", sink).count() == 0
    assert len(SCHEMA) == 5
    # A full load reads all files and replaces what was there.
    assert step("", sink, "full").first().rows_in == 6
    assert names(current_run_folders(spark, lake, "acc")) == expected((range(6), "n"))
    with pytest.raises(ValueError, match="upsert"):
        step(text([9]), sink, "upsert")
    with pytest.raises(ValueError, match="mode"):
        step("", sink, "replace")


def test_versioned_table(spark, lake, step):
    sink = VersionedSink(lake)
    step(text(range(20)), sink, "upsert")  # no table yet: an append
    log = step(text([3, 4, 30], "m"), sink, "upsert")
    rest = [i for i in range(20) if i not in (3, 4)]
    assert names(current(spark, lake, "acc")) == expected((rest, "n"), ([3, 4, 30], "m"))
    # Only the buckets of the three keys were written.
    touched = log.first().replaced
    assert 0 < len(touched) <= 3
    written = {d for d in os.listdir(log.first().place) if d.startswith("lake_bucket=")}
    assert written == {f"lake_bucket={b}" for b in touched}
    step(text([3], "m", version=2), sink, "append")
    assert current(spark, lake, "acc").count() == 22
    # A column more; rows keep it through a later upsert without it.
    wide = T.StructType([*SCHEMA.fields, T.StructField("extra", T.StringType())])
    step("".join(f"id{i},1,,w,0,more\n" for i in (5, 40)), sink, "upsert", schema=wide)
    step(text([40], "z"), sink, "upsert")
    rows = {r.Id: r for r in current(spark, lake, "acc").where("versionnumber = 1").collect()}
    assert (rows["id40"].name, rows["id40"].extra) == ("z\n40", "more")
    assert (rows["id5"].extra, rows["id6"].extra) == ("more", None)
    before = current(spark, lake, "acc").count()
    # A full load leaves one run.
    step("", sink, "full", schema=wide)
    assert len(live_runs(spark, lake, "acc")) == 1
    assert current(spark, lake, "acc").count() == before + 4


def test_a_run_that_died_before_its_log_row_is_not_read(spark, lake, step, monkeypatch):
    sink = VersionedSink(lake)
    step(text(range(5)), sink)
    append = ledger.append

    def die(rows, table):
        if table == lake.loads:
            raise RuntimeError("lost")
        append(rows, table)

    monkeypatch.setattr(loading.ledger, "append", die)
    with pytest.raises(RuntimeError):
        step(text(range(5, 8)), sink)
    monkeypatch.setattr(loading.ledger, "append", append)
    assert current(spark, lake, "acc").count() == 5
    step("", sink)
    assert names(current(spark, lake, "acc")) == expected((range(8), "n"))


@pytest.mark.parametrize("make", [VersionedSink, RunFolderSink, lambda c: CatalogTableSink(c.log_schema, "parquet")])
@pytest.mark.parametrize("empty_first", [True, False])
def test_rows_beyond_the_cutoff(spark, lake, step, make, empty_first):
    sink = make(lake)
    # All rows are filtered away: logged with no rows, and not read again.
    bodies = [(text(range(3, 5), year=2300), 0), (text(range(3)), 3)]
    for body, rows in bodies if empty_first else reversed(bodies):
        log = step(body, sink).first()
        assert (log.rows_in, log.live, log.rows_bad) == (rows, rows > 0, 0)
        assert ledger.pending(spark, lake, "acc").count() == 0
    if isinstance(sink, VersionedSink):
        assert step(text([1], year=2300), sink, "upsert").first().rows_in == 0
        assert current(spark, lake, "acc").count() == 3


def test_a_stream_batch_beyond_the_cutoff(spark, lake, put, tmp_path):
    for second, mode in enumerate(("append", "upsert")):
        put("acc", "p.csv", text(range(3), year=2300))
        copy_growth(spark, lake, ["acc"], run_ts=START + dt.timedelta(seconds=second))
        stream_load(spark, lake, "acc", SCHEMA, VersionedSink(lake), str(tmp_path / "state"), mode).awaitTermination()
        assert ledger.pending(spark, lake, "acc").count() == 0, mode
    assert [r.rows_in for r in spark.table(lake.loads).collect()] == [0, 0]


def test_loads_are_ordered_by_their_number(spark, lake, put):
    """The clock steps back between two upserts; a second load in the same second has a folder of its own."""
    days = [dt.timedelta(days=d) for d in (0, 2, 1, 1)]
    for i, name in enumerate(("first", "second", "third", "fourth")):
        put("acc", "p.csv", text([1], name))
        copy_growth(spark, lake, ["acc"], run_ts=START + days[i])
        log = load_entity(spark, lake, "acc", SCHEMA, VersionedSink(lake), "upsert", run_ts=START + days[i]).first()
        assert log.number == i + 1 and log.started <= log.ended
        assert names(current(spark, lake, "acc")) == [("id1", f"{name}1")]
    for _ in range(2):
        load_entity(spark, lake, "acc", SCHEMA, RunFolderSink(lake), "full", run_ts=START)
    assert current_run_folders(spark, lake, "acc").count() == 4


def test_a_number_is_taken_once(spark, lake):
    with ThreadPoolExecutor(8) as pool:
        taken = list(pool.map(lambda _: ledger.take_number(spark, lake, "acc"), range(16)))
    assert sorted(taken) == list(range(1, 17))
    assert ledger.take_number(spark, lake, "other") == 1


def test_logs_of_an_earlier_version(spark, lake, step):
    step(text([1]), VersionedSink(lake))
    old = spark.table(lake.loads).drop("number", "started", "ended")
    rows = old.collect()
    spark.sql(f"drop table {lake.loads}")
    place = f"{lake.log_root}/old-loads"
    spark.createDataFrame(rows, old.schema).write.parquet(place)
    spark.sql(f"create table {lake.loads} ({old.schema.toDDL()}) using parquet location '{place}'")
    step(text([1], "m"), VersionedSink(lake), "upsert")
    assert names(current(spark, lake, "acc")) == [("id1", "m1")]


def test_a_full_load_without_rows_keeps_the_table(spark, lake, step, monkeypatch):
    sink = VersionedSink(lake)
    step(text([1]), sink)
    nothing = spark.createDataFrame([], "target string, bytes bigint")
    monkeypatch.setattr(ledger, "available", lambda *_: nothing)
    assert step("", sink, "full").count() == 0
    assert current(spark, lake, "acc").count() == 1


def test_malformed_rows_are_counted(spark, lake, step):
    body = 'id1,1,"1/5/2024 3:04:05 PM",n,0\nid2,x,"13/45/2024 3:04:05 PM",n,0\nid3,1\nid4,1,,n,0,surplus\n'
    log = step(body, RunFolderSink(lake)).first()
    assert (log.rows_in, log.rows_bad) == (4, 3)
    rows = {r.Id: r for r in current_run_folders(spark, lake, "acc").collect()}
    assert rows["id2"].versionnumber is None and rows["id2"].SinkCreatedOn is None
    assert rows["id3"].name is None and rows["id4"].name == "n"


def test_labels_are_added(spark, lake, step):
    option = {
        "EntityName": "acc", "IsUserLocalizedLabel": True, "LocalizedLabelLanguageCode": 1040,
        "OptionSetName": "statecode",
    }
    options = [{**option, "Option": i, "LocalizedLabel": x} for i, x in enumerate(("even", "odd"))]
    path = lake.option_path("acc")
    os.makedirs(os.path.dirname(path))
    with open(path, "w") as out:
        json.dump({"OptionSetMetadata": options, "GlobalOptionSetMetadata": []}, out)
    step(text(range(3)), RunFolderSink(lake), with_labels=True)
    rows = current_run_folders(spark, lake, "acc").collect()
    assert sorted((r.Id, r.statecode_descr) for r in rows) == [("id0", "even"), ("id1", "odd"), ("id2", "even")]


def test_many_entities(spark, lake, put):
    for name in ("a", "b", "c"):
        put(name, "p.csv", text(range(3)))
    copy_growth(spark, lake, ["a", "b", "c"])
    log = load_entities(spark, lake, dict.fromkeys(("a", "b", "none"), SCHEMA), RunFolderSink(lake))
    assert sorted(r.entity for r in log.collect()) == ["a", "b"]
    bad = T.StructType([T.StructField("x", T.LongType())])
    with pytest.raises(ExceptionGroup) as info:
        load_entities(spark, lake, {"c": SCHEMA, "a": bad}, VersionedSink(lake), "replace")
    assert len(info.value.exceptions) == 2
    assert spark.table(lake.loads).count() == 2


def test_files_without_their_load_are_pending(spark, lake, step):
    """One row per load, whatever the number of files; a death between the logs leaves nothing half-loaded."""
    sink = VersionedSink(lake)
    for i in range(6):
        step(text([i]), sink)
    lost = spark.table(lake.copies).select(F.lit("dead").alias("load_id"), "target")
    ledger.append(lost, lake.load_files)
    assert ledger.pending(spark, lake, "acc").count() == 0
    before = spark.table(lake.loads).count()
    (log,) = step("", sink, "full").collect()
    assert log.rows_in == 6 and log.live and before == 6
    assert spark.table(lake.load_files).where(F.col("load_id") == log.load_id).count() == 6
    assert spark.table(lake.loads).count() == 7


def test_a_death_inside_the_log_commit(spark, lake, step, monkeypatch):
    append = ledger.append

    def die(rows, table):
        if table == lake.loads:
            raise RuntimeError("lost")
        append(rows, table)

    monkeypatch.setattr(loading.ledger, "append", die)
    with pytest.raises(RuntimeError):
        step(text(range(3)), VersionedSink(lake))
    monkeypatch.setattr(loading.ledger, "append", append)
    assert spark.table(lake.load_files).count() > 0 and ledger.pending(spark, lake, "acc").count() > 0
    step("", VersionedSink(lake))
    assert names(current(spark, lake, "acc")) == expected((range(3), "n"))


def test_a_table_keeps_its_bucket_count_and_keys(spark, lake, step):
    step(text(range(40)), VersionedSink(lake))
    other = dataclasses.replace(lake, bucket_count=5)
    step(text(range(3), "m"), VersionedSink(other), "upsert")
    assert names(current(spark, lake, "acc")) == expected((range(3), "m"), (range(3, 40), "n"))
    with pytest.raises(ValueError, match="bucketed by"):
        step(text([50]), VersionedSink(lake, keys=["Id"]), "upsert")


@pytest.mark.parametrize("sink", [VersionedSink, RunFolderSink])
def test_a_type_change_is_refused_before_the_log(spark, lake, step, sink):
    step(text(range(3)), sink(lake))
    fields = [T.StructField("versionnumber", T.StringType()) if f.name == "versionnumber" else f for f in SCHEMA.fields]
    with pytest.raises(ValueError, match="versionnumber"):
        step(text(range(3, 5)), sink(lake), schema=T.StructType(fields))
    assert spark.table(lake.loads).count() == 1
    step("", sink(lake), "full", schema=T.StructType(fields))
    rows = current(spark, lake, "acc") if sink is VersionedSink else current_run_folders(spark, lake, "acc")
    assert rows.count() == 5 and rows.schema["versionnumber"].dataType == T.StringType()


WIDER = [
    (T.IntegerType(), T.LongType(), T.LongType()), (T.FloatType(), T.DoubleType(), T.DoubleType()),
    (T.IntegerType(), T.DoubleType(), T.DoubleType()), (T.LongType(), T.DecimalType(10, 2), T.DecimalType(22, 2)),
    (T.DecimalType(8, 3), T.DecimalType(12, 1), T.DecimalType(14, 3)),
    (T.LongType(), T.IntegerType(), None), (T.LongType(), T.DoubleType(), None), (T.DoubleType(), T.FloatType(), None),
    (T.StringType(), T.LongType(), None), (T.DecimalType(38, 0), T.DecimalType(38, 10), None),
]


@pytest.mark.parametrize("sink", [VersionedSink, RunFolderSink])
@pytest.mark.parametrize(("old", "new", "read"), WIDER, ids=str)
def test_types_get_wider_only(spark, lake, step, sink, old, new, read):
    def schema(kind):
        return T.StructType([T.StructField("Id", T.StringType()), T.StructField("versionnumber", T.LongType()), T.StructField("amount", kind)])

    mode = "upsert" if sink is VersionedSink else "append"
    step("id1,1,5\nid2,1,6\n", sink(lake), mode, schema=schema(old))
    if read is None:
        with pytest.raises(ValueError, match="amount"):
            step("id3,1,7\n", sink(lake), mode, schema=schema(new))
        assert spark.table(lake.loads).count() == 1
        return
    step("id2,1,7\nid3,1,8\n", sink(lake), mode, schema=schema(new))
    rows = current(spark, lake, "acc") if sink is VersionedSink else current_run_folders(spark, lake, "acc")
    assert rows.schema["amount"].dataType == read
    values = [("id1", 5.0), ("id2", 7.0), ("id3", 8.0)] + [("id2", 6.0)] * (sink is RunFolderSink)
    assert sorted((r.Id, float(r.amount)) for r in rows.collect()) == sorted(values)


def test_a_key_keeps_its_type(spark, lake, step):
    step("id1,1\n", VersionedSink(lake), schema=T.StructType([T.StructField("Id", T.StringType()), T.StructField("versionnumber", T.IntegerType())]))
    with pytest.raises(ValueError, match="versionnumber"):
        step("id1,1\n", VersionedSink(lake), schema=T.StructType([T.StructField("Id", T.StringType()), T.StructField("versionnumber", T.LongType())]))


def test_a_full_load_without_rows_keeps_a_catalog_table(spark, lake, step, monkeypatch):
    sink = CatalogTableSink(lake.log_schema, "parquet")
    step(text([1]), sink)
    whole = ledger.available
    monkeypatch.setattr(ledger, "available", lambda *a: whole(*a).where(~F.col("target").endswith("_000000000000000.csv")))
    assert step(text([5], year=2300), sink, "full").first().rows_in == 0
    assert spark.table(f"{lake.log_schema}.acc").count() == 1


def test_logs_outlive_the_catalog(spark, lake, put):
    put("acc", "p.csv", text(range(2)))
    copy_growth(spark, lake, ["acc"])
    spark.sql(f"drop table {lake.copies}")
    ledger.ensure_logs(spark, lake)
    assert spark.table(lake.copies).where(F.col("outcome") == ledger.DONE).count() > 0


def test_a_stream_loads_each_range_once(spark, lake, put, tmp_path):
    sink, checkpoint = VersionedSink(lake), str(tmp_path / "state")
    for step, ids in enumerate((range(3), range(2, 6))):
        put("acc", "p.csv", text(ids, f"r{step}-"))
        copy_growth(spark, lake, ["acc"], run_ts=START + dt.timedelta(minutes=step))
        stream_load(spark, lake, "acc", SCHEMA, sink, checkpoint, "upsert").awaitTermination()
    assert names(current(spark, lake, "acc")) == expected((range(2), "r0-"), (range(2, 6), "r1-"))
    # The state of the stream is lost: all ranges come again, and none is loaded twice.
    stream_load(spark, lake, "acc", SCHEMA, sink, checkpoint + "-new", "append").awaitTermination()
    assert current(spark, lake, "acc").count() == 6
    assert spark.table(lake.loads).count() == 2
    with pytest.raises(ValueError, match="full"):
        stream_load(spark, lake, "acc", SCHEMA, sink, checkpoint, "full")


def test_catalog_tables(spark, lake, step):
    sink = CatalogTableSink(lake.log_schema, "parquet")
    step(text(range(3)), sink, "upsert")  # no table yet: an append
    log = step(text(range(3, 5)), sink).first()
    assert (log.place, log.kind) == (f"{lake.log_schema}.`acc`", "CATALOG")
    assert names(spark.table(log.place)) == expected((range(5), "n"))
    with pytest.raises(Exception, match="UNSUPPORTED|not support"):
        step(text([1], "m"), sink, "upsert")
    step("", sink, "full")
    assert spark.table(log.place).count() == 6


@pytest.mark.parametrize("by_stream", [False, True])
def test_a_catalog_load_that_died_before_its_log_row_is_not_made_again(spark, lake, step, put, tmp_path, monkeypatch, by_stream):
    sink = CatalogTableSink(lake.log_schema, "parquet")
    table = f"{lake.log_schema}.acc"
    append = ledger.append

    def die(rows, table):
        if table == lake.loads:
            raise RuntimeError("lost")
        append(rows, table)

    def load_again(body):
        if not by_stream:
            return step(body, sink)
        put("acc", "p.csv", body)
        copy_growth(spark, lake, ["acc"], run_ts=START + dt.timedelta(days=1))
        stream_load(spark, lake, "acc", SCHEMA, sink, f"{tmp_path}/checkpoint").awaitTermination()

    step(text(range(2)), sink)
    monkeypatch.setattr(loading.ledger, "append", die)
    with pytest.raises(RuntimeError):
        step(text(range(2, 5)), sink)
    monkeypatch.setattr(loading.ledger, "append", append)
    assert spark.table(table).count() == 5 and ledger.pending(spark, lake, "acc").count() > 0
    # Files that came since then are loaded, those of the dead load are not loaded again.
    load_again(text(range(5, 7)))
    spark.catalog.refreshTable(table)
    assert names(spark.table(table)) == expected((range(7), "n"))
    assert ledger.pending(spark, lake, "acc").count() == 0
    rows = ledger.log(spark, lake.loads).orderBy("number").collect()
    assert [r.rows_in for r in rows] == [2, 3, 2] and {r.load_id for r in rows} == {r[0] for r in spark.table(table).select(sink.mark).distinct().collect()}
    assert ledger.begun(spark, lake) == []


def test_a_load_that_died_before_its_rows_came_is_made_again(spark, lake, step, monkeypatch):
    sink = CatalogTableSink(lake.log_schema, "parquet")
    spark.sql(f"CREATE TABLE {lake.log_schema}.acc ({SCHEMA.toDDL()}, _partition_modification_time timestamp, _file_path string) USING parquet")
    write = CatalogTableSink.write

    def die(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(CatalogTableSink, "write", die)
    with pytest.raises(RuntimeError):
        step(text(range(3)), sink)
    monkeypatch.setattr(CatalogTableSink, "write", write)
    assert len(ledger.begun(spark, lake)) == 1
    step("", sink)  # into a table of an earlier version, without marks
    assert names(spark.table(f"{lake.log_schema}.acc")) == expected((range(3), "n"))


def test_file_names_with_special_characters(spark, lake, put):
    for i, name in enumerate(("p 1.csv", "p#é%20.csv", "p[2]{a,b}*.csv")):
        put("acc", name, text(range(3 * i, 3 * i + 3)))
    log = copy_growth(spark, lake, ["acc"]).collect()
    assert {r.outcome for r in log} == {ledger.DONE}
    assert {os.path.basename(r.path) for r in log} == {"p 1.csv", "p#é%20.csv", "p[2]{a,b}*.csv"}
    load_entity(spark, lake, "acc", SCHEMA, RunFolderSink(lake))
    assert names(current_run_folders(spark, lake, "acc")) == expected((range(9), "n"))
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(seconds=5)
    assert copy_growth(spark, lake, ["acc"], run_ts=later).count() == 0


@pytest.fixture
def odd_files(spark, lake, put):
    bodies = [text(range(3)), 'id7,x,"13/45/2024 3:04:05 PM",n,0\nid8,1\nid9,1,,n,0,surplus\n\nid10,1,,"a ""b"", c\n",1\n', 'id11,1,,5" wide,1\r\n', "\n"]
    for name, body in zip(("p 1.csv", "p#é%20.csv", "p[2]{a,b}*.csv", "p+&=@;'(~).csv"), bodies):
        put("acc", name, body)
    copy_growth(spark, lake, ["acc"], run_ts=START)
    return ledger.available(spark, lake, "acc")


def test_files_of_a_table_give_the_rows_of_a_list(spark, lake, odd_files):
    paths = [literal(r[0]) for r in odd_files.select("target").collect()]
    assert len(paths) == 4
    for options in ({}, {"keep_corrupt": True}, {"file_columns": False}):
        listed = records.read_listed(odd_files, SCHEMA, 2, **options)
        whole = records.read(spark, paths, SCHEMA, **options)
        assert listed.schema.simpleString() == whole.schema.simpleString()
        assert sorted(map(repr, listed.collect())) == sorted(map(repr, whole.collect()))
    missing = spark.createDataFrame([(f"{lake.range_root}/none.csv",)], "target string")
    with pytest.raises(Exception, match="none.csv"):
        records.read_listed(missing, SCHEMA, 1).collect()


def test_a_load_of_many_files_lists_none(spark, lake, odd_files, monkeypatch):
    monkeypatch.setattr(loading, "LISTED_FILES", 3)
    monkeypatch.setattr(records, "read", None)
    spark.sparkContext.setJobGroup("many", "a load")
    log = load_entity(spark, lake, "acc", SCHEMA, RunFolderSink(lake)).first()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("many"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert (log.rows_in, log.rows_bad) == (8, 3)
    assert sorted(r.Id for r in current_run_folders(spark, lake, "acc").collect()) == sorted(f"id{i}" for i in (0, 1, 2, 7, 8, 9, 10, 11))
    assert spark.table(lake.load_files).count() == 4
    print("jobs of a load:", jobs)


def test_reading_an_entity_shuffles_nothing_and_prunes_columns(spark, lake, put):
    put("acc", "p.csv", text(range(3)))
    copy_growth(spark, lake, ["acc"])
    files = [r[0] for r in ledger.available(spark, lake, "acc").select("target").collect()]
    rows = loading.read_entity(spark, files, SCHEMA)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    plan = rows.select("name")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<SinkCreatedOn:string,name:string>" in plan
