"""Operators that need no files besides the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from appendlake.functions import casts, guards, maps, paths
from appendlake.operators import growth, labels, ledger, merge, sets
from appendlake.operators.latest import latest
from appendlake.queries.catalog import query, table
from appendlake.session import persist_counted
from appendlake.sources import options


def _time(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


@query(
    """
    select user_id, event_id, value from (
      select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
      from events where event_type <> 'error') where rn = 1
    """
)
def q_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "events").where("event_type <> 'error'")
    return latest(done, ["user_id"], ["ts"], ["event_id"]).select("user_id", "event_id", "value")


@query(
    """
    select o_custkey, o_orderkey, o_totalprice from (
      select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
      from orders) where rn = 1
    """
)
def q_current_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate"], ["o_orderkey"])
    return rows.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    """
    select event_type as entity, cast(user_id as varchar) as path, max(event_id) as stop
    from events where value is not null and event_type in ('click', 'view') group by all
    """
)
def q_file_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state query of the log of copies, with events as its rows of two entities."""
    log = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("entity"),
        F.concat_ws("/", "event_type", "user_id").alias("path"),
        F.col("event_id").alias("stop"),
        F.when(F.col("value").isNull(), "no value").otherwise(ledger.DONE).alias("outcome"),
    )
    wanted = log.where(guards.in_list_or_all(F.col("entity"), ["click", "view"]))
    parts = F.split("path", "/")
    return ledger.state_of(wanted).select(
        F.element_at(parts, 1).alias("entity"), F.element_at(parts, 2).alias("path"), "stop"
    )


@query("select o_custkey from orders except all select c_custkey from customer")
def q_except_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.multiset_difference(
        table(spark, sf_dir, "orders").select("o_custkey"),
        table(spark, sf_dir, "customer").select("c_custkey"),
    )


@query("select doc_id from documents where doc_id not in (select doc_id from labels where doc_id is not null)")
def q_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that no label names, as files that no load names."""
    documents, labels = (table(spark, sf_dir, name).select("doc_id") for name in ("documents", "labels"))
    return sets.absent_from(documents, labels, ["doc_id"])


_SIZES_SQL = """
    with listing as (select l_orderkey as path, count(*) as size from lineitem group by 1),
    state as (select l_orderkey as path, count(*) as stop from lineitem
              where l_shipdate < timestamp '2000-01-01' group by 1)
"""


def _sizes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lines per order stand for bytes per file; the state is the count before 2000."""
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "path")
    listing = lines.groupBy("path").agg(F.count(F.lit(1)).alias("size"))
    earlier = lines.where(F.col("l_shipdate") < _time("2000-01-01"))
    return listing, earlier.groupBy("path").agg(F.count(F.lit(1)).alias("stop"))


@query(
    _SIZES_SQL
    + """
    select path, coalesce(stop, 0) as start,
           size - coalesce(stop, 0) as fresh, size as stop
    from listing left join state using (path)
    where size - coalesce(stop, 0) > 0
    """
)
def q_growth_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return growth.plan(*_sizes(spark, sf_dir))


@query(
    """
    with listing as (select o_custkey as path, count(*) as size from orders
                     where o_orderdate >= timestamp '1998-06-01' group by 1),
    state as (select o_custkey as path, count(*) as stop from orders
              where o_orderdate < timestamp '1998-06-01' group by 1)
    select path, size, coalesce(stop, 0) as start,
           size - coalesce(stop, 0) as fresh,
           case when size > coalesce(stop, 0) then 'grown'
                when size = coalesce(stop, 0) then 'same' else 'shrunk' end as status
    from listing left join state using (path)
    """
)
def q_growth_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "path")
    is_late = F.col("o_orderdate") >= _time("1998-06-01")
    listing = orders.where(is_late).groupBy("path").agg(F.count(F.lit(1)).alias("size"))
    state = orders.where(~is_late).groupBy("path").agg(F.count(F.lit(1)).alias("stop"))
    return growth.compare(listing, state)


@query(
    """
    select o_orderkey, o_orderdate from orders
    where o_orderdate is null or cast(o_orderdate as date) <= date '1996-06-30'
    """
)
def q_date_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = guards.date_guard(table(spark, sf_dir, "orders"), ["o_orderdate"], "1996-06-30")
    return rows.select("o_orderkey", "o_orderdate")


@query(
    """
    with n as (select o_orderkey, o_custkey, o_totalprice * 2 as o_totalprice, o_orderstatus from orders
               where o_orderdate >= timestamp '1998-01-01'),
    t as (select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders
          where o_orderdate < timestamp '1999-01-01')
    select coalesce(t.o_orderkey, n.o_orderkey) as o_orderkey, coalesce(t.o_custkey, n.o_custkey) as o_custkey,
           coalesce(n.o_totalprice, t.o_totalprice) as o_totalprice, t.o_orderpriority, n.o_orderstatus
    from t full join n on t.o_orderkey = n.o_orderkey and t.o_custkey = n.o_custkey
    """
)
def q_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before 1999 as the table, orders since 1998 with another price as the source."""
    orders = table(spark, sf_dir, "orders")
    target = orders.where(F.col("o_orderdate") < _time("1999-01-01")).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )
    source = orders.where(F.col("o_orderdate") >= _time("1998-01-01")).select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), "o_orderstatus"
    )
    return merge.merge(target, source, ["o_orderkey", "o_custkey"])


@query(
    """
    select c_custkey, c_mktsegment, n_name as c_nationkey_descr
    from customer left join nation on c_nationkey = n_nationkey
    """
)
def q_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nations = table(spark, sf_dir, "nation")
    return labels.lookup(
        customers, nations, "c_nationkey", "n_nationkey", "n_name", "c_nationkey_descr"
    ).drop("c_nationkey")


@query(
    """
    select s_suppkey, n_name as nation_descr, r_name as region_descr from supplier
    left join nation on s_nationkey = n_nationkey left join region on n_regionkey = r_regionkey
    """
)
def q_enrich_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    by_region = labels.lookup(nations, regions, "n_regionkey", "r_regionkey", "r_name", "region_descr")
    named = labels.lookup(suppliers, nations, "s_nationkey", "n_nationkey", "n_name", "nation_descr")
    return labels.lookup(
        named, by_region, "s_nationkey", "n_nationkey", "region_descr", "region_descr"
    ).drop("s_nationkey")


@query(
    """
    select c_custkey, n_name as exact_descr, case when c_custkey % 2 = 0 then n_name end as double_descr,
           case when c_custkey % 3 > 0 then n_name end as text_descr,
           (select n_name from nation where n_nationkey = case when c_nationkey > 0 then 1 else 0 end) as flag_descr
    from customer left join nation on c_nationkey = n_nationkey
    """
)
def q_map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes as number, double, text and boolean; broadcast and shuffled labels in turn."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        nation.alias("exact"),
        (nation + F.when(key % 2 == 0, 0.0).otherwise(0.5)).alias("double"),
        F.concat(F.when(key % 3 > 0, "").otherwise("0"), nation.cast("string")).alias("text"),
        (nation > 0).alias("flag"),
    )
    nations = table(spark, sf_dir, "nation")
    for i, column in enumerate(["exact", "double", "text", "flag"]):
        rows = labels.lookup(rows, nations, column, "n_nationkey", "n_name", f"{column}_descr", i % 2 == 0)
    return rows.drop("exact", "double", "text", "flag")


@query(
    """
    select o_orderkey, c_name as o_custkey_descr from orders left join customer on o_custkey = c_custkey
    """
)
def q_lookup_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup as it runs when the labels are too large to broadcast."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer")
    return labels.lookup(
        orders, customers, "o_custkey", "c_custkey", "c_name", "o_custkey_descr", False
    ).drop("o_custkey")


@query(
    """
    select doc_id, quality, toxic,
           case when quality is not null then 'quality ' || quality end as quality_descr,
           case when toxic is not null then 'toxic ' || toxic end as toxic_descr
    from labels
    """
)
def q_enrich_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two coded columns, labelled from option rows; a global set repeats one of them."""
    rows = table(spark, sf_dir, "labels")

    def set_rows(column: str, shared: bool) -> DataFrame:
        text = F.concat(F.lit("global " if shared else ""), F.lit(column + " "), F.col(column))
        return rows.select(
            F.lit("labels").alias("EntityName"),
            F.lit(True).alias("IsUserLocalizedLabel"),
            text.alias("LocalizedLabel"),
            F.lit(1033).cast("bigint").alias("LocalizedLabelLanguageCode"),
            F.col(column).cast("bigint").alias("Option"),
            F.lit(column).alias("OptionSetName"),
            F.lit(shared).alias("IsGlobal"),
        )

    sets_found = set_rows("quality", False).unionByName(set_rows("toxic", False))
    sets_found = sets_found.unionByName(set_rows("quality", True)).distinct()
    return labels.enrich(rows, sets_found)


@query(
    """
    select source as set_name, n_chars as code, min(lang) as label from documents group by 1, 2
    """
)
def q_one_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label per set and code, where the data has several."""
    rows = table(spark, sf_dir, "documents").select(
        F.lit(True).alias("IsUserLocalizedLabel"),
        F.col("lang").alias("LocalizedLabel"),
        F.col("n_chars").alias("Option"),
        F.col("source").alias("OptionSetName"),
        F.lit(False).alias("IsGlobal"),
    )
    return options.one_per_code(rows).select(
        F.col("OptionSetName").alias("set_name"),
        F.col("Option").alias("code"),
        F.col("LocalizedLabel").alias("label"),
    )


@query(
    """
    select doc_id, md5(line) as line_md5
    from (select doc_id, unnest(string_split(text, chr(10))) as line from documents) where line <> ''
    union all
    select doc_id, null from documents where replace(text, chr(10), '') = ''
    """
)
def q_explode_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each text; a text without any keeps one row."""
    lines = F.filter(F.split("text", "\n"), lambda line: line != "")
    exploded = table(spark, sf_dir, "documents").select("doc_id", F.explode_outer(lines).alias("line"))
    return exploded.select("doc_id", F.md5("line").alias("line_md5"))


@query(
    """
    select c_custkey as id, c_name as name, c_mktsegment as segment, null::double as balance from customer
    union all select s_suppkey, s_name, null, s_acctbal from supplier
    """
)
def q_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge in which no key matches: both sides by name, null where a side lacks a column."""
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as id", "c_name as name", "c_mktsegment as segment"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_acctbal as balance", "s_suppkey as id", "s_name as name"
    )
    return merge.merge(customers, suppliers, ["id", "name"])


@query(
    r"""
    select page_id,
           coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), ''), '1') as page,
           nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') as ref,
           1 + (case when url like '%ref=%' then 1 else 0 end)
             + (case when url like '%utm_source=%' then 1 else 0 end) as n
    from pages
    """
)
def q_kv_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query arguments of a URL; a default that comes first loses to the argument."""
    found = F.regexp_extract("url", r"\?([^#]*)", 1)
    arguments = F.transform(
        F.filter(F.split(found, "&"), lambda a: a != ""),
        lambda a: F.struct(
            F.split(a, "=")[0].alias("name"), F.try_element_at(F.split(a, "="), F.lit(2)).alias("value")
        ),
    )
    default = F.array(F.struct(F.lit("page").alias("name"), F.lit("1").alias("value")))
    pairs = table(spark, sf_dir, "pages").select(
        "page_id", maps.last_wins_map(F.concat(default, arguments)).alias("m")
    )
    return pairs.select(
        "page_id",
        F.try_element_at("m", F.lit("page")).alias("page"),
        F.try_element_at("m", F.lit("ref")).alias("ref"),
        F.size("m").alias("n"),
    )


@query(
    """
    select event_id, date_trunc('second', ts) as twelve_hour, ts as iso, null::timestamp as bad from events
    """
)
def q_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both timestamp forms, written as the export writes them and parsed again."""
    ts = F.col("ts")
    text = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(ts, "M/d/yyyy h:mm:ss a").alias("twelve_hour"),
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("7Z")).alias("iso"),
        F.concat(F.lit("13/45/2024 "), F.date_format(ts, "hh:mm:ss a")).alias("bad"),
    )
    zone = F.current_timezone()

    def plain(name: str) -> Column:
        return F.convert_timezone(
            zone, F.lit("UTC"), casts.parse_timestamp(F.col(name)).cast("timestamp_ntz")
        ).alias(name)

    return text.select(
        "event_id",
        casts.parse_timestamp(F.col("twelve_hour")).cast("timestamp_ntz").alias("twelve_hour"),
        plain("iso"),
        plain("bad"),
    )


@query(
    r"""
    select page_id, regexp_extract(split_part(url, '/', -1), '^(.+?)(\.[^.]*)?$', 1) as stem from pages
    """
)
def q_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", paths.stem(F.col("url")).alias("stem"))


@query(
    """
    select page_id, '/data/' || ltrim(case when starts_with(url, 'https://') then substr(url, 9) else url end, '/')
      as path from pages
    """
)
def q_prefix_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = paths.remap_prefix(F.col("url"), "https://", "/data/")
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path"))


@query(
    """
    select event_id, strftime(ts, '%Y%m%d%H%M%S') as file_stamp, strftime(ts, '%Y%m%d_%H%M%S') as folder_stamp,
           (epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 1e6 as seconds
    from events
    """
)
def q_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    day = F.date_trunc("day", ts.cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        paths.file_stamp(ts).alias("file_stamp"),
        paths.folder_stamp(ts).alias("folder_stamp"),
        paths.seconds_between(day, ts.cast("timestamp")).alias("seconds"),
    )


@query("select count(*) as n, count(*) = 0 as is_empty from lineitem")
def q_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count that a write takes along."""
    _, seen = persist_counted(table(spark, sf_dir, "lineitem"), "counted", n=F.count(F.lit(1)))
    return spark.createDataFrame([(seen["n"], seen["n"] == 0)], "n bigint, is_empty boolean")


@query("select distinct l_suppkey, l_returnflag from lineitem")
def q_distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query(
    """
    select conv_id, turn, role from conversations where role in ('user', 'system')
    union all select conv_id, turn, 'any' from conversations
    """
)
def q_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of listed roles; an empty list lists all."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    listed = turns.where(guards.in_list_or_all(F.col("role"), ["user", "system"]))
    every = turns.where(guards.in_list_or_all(F.col("role"), []))
    return listed.unionByName(every.withColumn("role", F.lit("any")))
