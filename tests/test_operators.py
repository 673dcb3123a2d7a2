import datetime as dt
import random
from collections import Counter
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appendlake.functions import casts, guards, maps, paths
from appendlake.operators import labels, ledger, merge, sets
from appendlake.operators.latest import latest
from appendlake.session import scratch_dir
from appendlake.sources import options


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_state_ignores_failures_and_clocks(spark):
    log = spark.createDataFrame(
        [("a", 10, 9, "done"), ("a", 20, 2, "done"), ("a", 30, 3, "failed"), ("b", 5, 1, "done"), ("b", 7, 1, "done"), ("c", 9, 1, "failed")],
        "path string, stop bigint, run bigint, outcome string",
    )
    assert {r.path: r.stop for r in ledger.state_of(log).collect()} == {"a": 20, "b": 7}
    assert ledger.state_of(log.limit(0)).count() == 0


def test_latest_sends_one_row_per_key_and_task(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = latest(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_multiset_difference_counts_copies(spark):
    rng = random.Random(5)
    left = [rng.choice(["a", "b", "c", None]) for _ in range(300)] + ["hot"] * 900
    right = [rng.choice(["a", "b", "d", None]) for _ in range(100)] + ["hot"] * 100
    got = sets.multiset_difference(
        spark.createDataFrame([(x,) for x in left], "u string"),
        spark.createDataFrame([(x,) for x in right], "v string"),
    )
    assert Counter(r.u for r in got.collect()) == Counter(left) - Counter(right)


def test_absent_from_keeps_null_keys(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "u string")
    right = spark.createDataFrame([("a",), ("a",), (None,)], "u string")
    assert sorted(map(str, (r.u for r in sets.absent_from(left, right, ["u"]).collect()))) == ["None", "b"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("1/5/2024 3:04:05 PM", dt.datetime(2024, 1, 5, 15, 4, 5)),
        ("01/05/2024 12:00:00 AM", dt.datetime(2024, 1, 5)),
        ("12/31/2024 12:59:59 PM", dt.datetime(2024, 12, 31, 12, 59, 59)),
        ("2024-01-05T15:04:05.1234567Z", dt.datetime(2024, 1, 5, 15, 4, 5, 123456)),
        ("2024-01-05 15:04:05", dt.datetime(2024, 1, 5, 15, 4, 5)),
        ("13/45/2024 1:00:00 PM", None),
        ("13/01/2024 13:00:00 PM", None),
        ("no date", None),
        ("", None),
        (None, None),
    ],
)
def test_timestamps(spark, text, expected):
    assert value(spark, casts.parse_timestamp(F.lit(text).cast("string"))) == expected


def test_names_from_paths(spark):
    for path, stem in [("/a/b/p1.csv", "p1"), ("p.tar.gz", "p.tar"), ("/x/.hidden", ".hidden"), ("/x/none", "none")]:
        assert value(spark, paths.stem(F.lit(path))) == stem
    prefix = "https://h/c"
    for path, mapped in [("https://h/c/e/f.csv", "/m/e/f.csv"), ("/e/f.csv", "/m/e/f.csv"), ("e.csv", "/m/e.csv")]:
        assert value(spark, paths.remap_prefix(F.lit(path), prefix, "/m/")) == mapped
    ts = F.lit("2024-03-05 14:05:06").cast("timestamp")
    assert value(spark, paths.file_stamp(ts)) == "20240305140506"
    assert value(spark, paths.folder_stamp(ts)) == "20240305_140506"
    assert value(spark, paths.seconds_between(ts, ts + F.expr("interval 1500 milliseconds"))) == 1.5


def test_last_entry_of_a_key_wins(spark):
    df = spark.createDataFrame(
        [([("a", "1"), ("b", "2"), ("a", "3"), (None, "4"), ("b", None)],), ([],), (None,)],
        "p array<struct<name: string, value: string>>",
    )
    got = [r[0] for r in df.select(maps.last_wins_map(F.col("p"))).collect()]
    assert got == [{"a": "3", "b": None}, {}, None]


@pytest.mark.parametrize("stored", [True, False])
def test_date_guard(spark, stored):
    day = dt.datetime
    df = spark.createDataFrame(
        [
            (1, None, None), (2, day(2262, 4, 11, 23, 59), None), (3, day(2262, 4, 12), None),
            (4, None, day(2300, 1, 6)), (5, day(2020, 1, 1), day(2020, 1, 1)),
        ],
        "id int, SinkCreatedOn timestamp, SinkModifiedOn timestamp",
    )
    assert [r.id for r in guards.date_guard(df, stored=stored).collect()] == [1, 2, 5]
    assert guards.date_guard(df.select("id")).count() == 5


def test_date_guard_reaches_the_scan(spark):
    path = scratch_dir(spark, "guard")
    spark.sql("select timestamp'2020-01-01' SinkCreatedOn").write.parquet(path)
    plan = guards.date_guard(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(SinkCreatedOn" in plan


def brute_merge(target, source, own, keys):
    """Rows as dicts; the rules of a merge, one row at a time."""
    result, used = [], set()
    for t in target:
        hits = [i for i, s in enumerate(source) if all(t[k] is not None and t[k] == s[k] for k in keys)]
        assert len(hits) < 2
        used |= set(hits)
        row = {**t, **source[hits[0]]} if hits else dict(t)
        result.append(row)
    return result + [s for i, s in enumerate(source) if i not in used]


def test_merge_against_a_row_loop(spark):
    rng = random.Random(2)
    key = lambda: (rng.choice(["a", "b", "c", "d", None]), rng.choice([1, 2, None]))
    target = [dict(zip(("Id", "versionnumber", "x", "kept"), (*key(), i, f"k{i}"))) for i in range(40)]
    seen, source = set(), []
    for i in range(20):
        k = key()
        if k not in seen or None in k:
            seen.add(k)
            source.append(dict(zip(("Id", "versionnumber", "x", "added"), (*k, 100 + i, i * 1.5))))
    t = spark.createDataFrame([tuple(r.values()) for r in target], "Id string, versionnumber bigint, x bigint, kept string")
    s = spark.createDataFrame([tuple(r.values()) for r in source], "Id string, versionnumber bigint, x bigint, added double")
    got = merge.merge(t, s, ["Id", "versionnumber"])
    assert got.columns == ["Id", "versionnumber", "x", "kept", "added"]
    expected = brute_merge(target, source, ["kept"], ["Id", "versionnumber"])
    assert Counter(map(str, (tuple(r) for r in got.collect()))) == Counter(
        str(tuple(r.get(c) for c in got.columns)) for r in expected
    )


def test_merge_has_two_scans_and_two_shuffles(spark, tmp_path):
    for name in ("t", "s"):
        spark.range(100).selectExpr("id as Id", "id as versionnumber", "'x' as v").write.parquet(f"{tmp_path}/{name}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        t, s = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("t", "s"))
        plan = merge.merge(t, s, ["Id", "versionnumber"])._jdf.queryExecution().sparkPlan().toString()
        full = merge.merge(t, s, ["Id", "versionnumber"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan") == 2 and full.count("Exchange hashpartitioning") == 2


def test_merge_refuses_two_source_rows_for_one_target_row(spark):
    t = spark.createDataFrame([("a", 1, 0)], "Id string, versionnumber bigint, x int")
    twice = spark.createDataFrame([("a", 1, 1), ("a", 1, 2)], t.schema)
    with pytest.raises(Exception, match=merge.DUPLICATE_MATCH):
        merge.merge(t, twice, ["Id", "versionnumber"]).collect()
    new = spark.createDataFrame([("b", 1, 1), ("b", 1, 2)], t.schema)
    assert merge.merge(t, new, ["Id", "versionnumber"]).count() == 3


LABELS = [
    ("e", True, "Open", 1040, 0, "statecode", False),
    ("e", True, "Shared open", 1040, 0, "statecode", True),
    ("e", True, "Closed", 1040, 1, "statecode", False),
    ("e", False, "Zeta", 1040, 1, "industrycode", True),
    ("e", True, "Eta", 1040, 1, "industrycode", True),
    ("e", True, "Nowhere", 1040, 1, "no_column", True),
]


@pytest.mark.parametrize(("limit", "broadcasts"), [(labels.BROADCAST_BYTES, 2), (170, 1), (0, 0)])
def test_enrich(spark, monkeypatch, limit, broadcasts):
    """One budget for all sets: what does not fit is shuffled, with the same result."""
    monkeypatch.setattr(labels, "BROADCAST_BYTES", limit)
    df = spark.createDataFrame(
        [(1, 0, 1), (2, 1, None), (3, 7, 2), (4, None, 1)], "id int, statecode bigint, industrycode bigint"
    )
    found = spark.createDataFrame(LABELS, options.LABEL_SCHEMA)
    with pytest.warns(UserWarning, match="no_column"):
        got = labels.enrich(df, found)
    assert got.columns == ["id", "statecode", "industrycode", "statecode_descr", "industrycode_descr"]
    assert sorted(tuple(r)[::1] for r in got.select("id", "statecode_descr", "industrycode_descr").collect()) == [
        (1, "Open", "Eta"), (2, "Closed", None), (3, None, None), (4, None, "Eta"),
    ]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == broadcasts and plan.count("SortMergeJoin") == 2 - broadcasts


@pytest.mark.parametrize("may_broadcast", [True, False, None])
@pytest.mark.parametrize(
    ("kind", "codes", "expected"),
    [
        ("string", ["1", "01", "x", None], ["one", None, None, None]),
        ("double", [1.0, 1.5, 2.0, None], ["one", None, "two", None]),
        ("boolean", [True, False, None], ["one", "zero", None]),
        ("decimal(5,1)", [Decimal("1.0"), Decimal("1.5"), None], ["one", None, None]),
    ],
)
def test_codes_of_another_type(spark, kind, codes, expected, may_broadcast):
    """Codes that become equal repeat no row; names with a dot and map columns are fine."""
    df = spark.createDataFrame([(i, c, {"m": 1}) for i, c in enumerate(codes)], f"id int, `a.b` {kind}, m map<string,int>")
    side = spark.createDataFrame([(0, "zero"), (1, "one"), (2, "two"), (None, "none")], "`c.d` bigint, `l.m` string")
    got = labels.lookup(df, side, "a.b", "c.d", "l.m", "x.y", may_broadcast)
    assert [r["x.y"] for r in got.orderBy("id").collect()] == expected


def test_labels_of_an_entity(spark, tmp_path):
    own = '{"EntityName":"acc","IsUserLocalizedLabel":true,"LocalizedLabel":"%s","LocalizedLabelLanguageCode":%d,"Option":%s,"OptionSetName":"statecode"}'
    glob = '{"IsUserLocalizedLabel":false,"LocalizedLabel":"G","LocalizedLabelLanguageCode":1040,"Option":0,"OptionSetName":"industrycode"}'
    rows = [own % ("Aperto", 1040, "0"), own % ("Open", 1033, "0"), own % ("Aperto", 1040, "0"), own % ("?", 1040, "null")]
    path = tmp_path / "acc-EntityMetadata.json"

    def read(text, **options_):
        path.write_text(text)
        found = options.read_labels(spark, str(path), "acc", **options_)
        return sorted((r.EntityName, r.LocalizedLabel, r.Option, r.OptionSetName) for r in found.where("Option is not null").collect())

    both = '{"OptionSetMetadata":[%s],"GlobalOptionSetMetadata":[%s]}' % (",".join(rows), glob)
    assert read(both) == [("acc", "Aperto", 0, "statecode"), ("acc", "G", 0, "industrycode")]
    assert read(both, language=1033) == [("acc", "Open", 0, "statecode")]
    patch = lambda df, entity: df.withColumn("LocalizedLabel", F.concat(F.lit(entity + ":"), "LocalizedLabel"))
    assert read(both, patch=patch)[0][1] == "acc:Aperto"
    assert read('{"OptionSetMetadata":[],"GlobalOptionSetMetadata":[%s]}' % glob) == [("acc", "G", 0, "industrycode")]
    assert read('{"OptionSetMetadata":[%s]}' % rows[0]) == [("acc", "Aperto", 0, "statecode")]
    assert options.read_labels(spark, str(tmp_path / "none.json"), "acc").count() == 0


def test_a_missing_code_is_no_label(spark):
    found = spark.createDataFrame([("e", True, "x", 1040, None, "s", False)], options.LABEL_SCHEMA)
    assert options.one_per_code(found).count() == 0


def test_scratch_folder_is_the_shared_one(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_cluster_needs_a_shared_folder():
    none = SimpleNamespace(
        conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="yarn")
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(none, "x")
