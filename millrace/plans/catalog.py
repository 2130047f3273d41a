"""The operators as queries over the star-schema test tables, each with an equivalent SQL where one can be written.

Events stand in for feeds: an entity is a user on a day, and each event type is one source that may know it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace import operators as op
from millrace.functions.columns import cast_columns, with_arrival, with_partitions
from millrace.plans import model as ml
from millrace.plans.gold import Assembly, reassemble
from millrace.plans.ingest import ingest_tick
from millrace.plans.silver import quarantined_rows, refine_source, valid_rows
from millrace.plans.store import BY_MONTH, Store
from millrace.session import scratch_path, tune, written
from millrace.sources.landing import SourceSpec, read_landing, readable
from millrace.sources.tables import ParquetTable
from millrace.streaming import BY_BATCH, BY_DAY, landing_stream, stream_by_lateness, stream_ingest, stream_windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WATERMARK = datetime(2024, 1, 10)
ENTITY = ["user_id", "event_date"]
SIDES = ("click", "view", "purchase")


def query(name: str, sql: str | None = None):
    """Register a query and, where there is one, its SQL."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(column: str | Column, digits: int = 6) -> Column:
    return F.round(column, digits)


# -- landing and ingest ------------------------------------------------------------------------------------------------

EVENT_TYPES = {
    "event_id": "BIGINT",
    "ts": "TIMESTAMP",
    "user_id": "BIGINT",
    "event_type": "STRING",
    "value": "DOUBLE",
    "props": "STRING",
}
EVENT_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def events_feed(
    fmt: str, keys: tuple[str, ...] = ("event_id",), window: timedelta = timedelta(hours=1), day_folder: str | None = None
) -> SourceSpec:
    return SourceSpec("events", fmt, EVENT_TYPES, keys, "ts", window, day_folder=day_folder)


def event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with their time as landing files have it."""
    rows = table(spark, sf_dir, "events").select(*EVENT_TYPES)
    return rows.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))


def land_events(spark: SparkSession, sf_dir: str, fmt: str) -> str:
    """The events as a landing directory with one folder per event type."""
    path = scratch_path(spark, f"landing-{fmt}")
    rows = event_texts(spark, sf_dir).withColumn("folder", F.col("event_type"))
    rows.write.partitionBy("folder").options(header="true").format(fmt).save(path)
    return path


def land_by_day(spark: SparkSession, rows: DataFrame) -> str:
    """Rows of a ``line`` and its ``day`` as a landing directory with a folder per day."""
    path = scratch_path(spark, "landing-days")
    rows.select("line", "day").hint("rebalance", "day").write.partitionBy("day").text(path)
    return path


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, ts, line, day): the events as JSON lines."""
    texts = event_texts(spark, sf_dir)
    return texts.select("event_id", "ts", F.to_json(F.struct(*EVENT_TYPES)).alias("line"), F.substring("ts", 1, 10).alias("day"))


def as_events(df: DataFrame) -> DataFrame:
    typed = cast_columns(df.select(*EVENT_TYPES), EVENT_TYPES)
    return typed.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("landing_csv_scan", EVENT_SQL)
def landing_csv_scan(spark, sf_dir):
    return as_events(read_landing(spark, events_feed("csv"), land_events(spark, sf_dir, "csv")))


@query("landing_json_scan", EVENT_SQL)
def landing_json_scan(spark, sf_dir):
    return as_events(read_landing(spark, events_feed("json"), land_events(spark, sf_dir, "json")))


@query(
    "ingest_window_slice",
    """
    SELECT event_id, ts, user_id, event_type, CAST(ts AS DATE) AS arrival_date,
           CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month
    FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'
    """,
)
def ingest_window_slice(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return with_partitions(
        with_arrival(op.window_slice(events, "ts", WATERMARK, WATERMARK + timedelta(days=10)), "ts"), "ts"
    )


@query("ingest_first_tick", "SELECT count(*) AS n_rows, max(ts) AS watermark FROM events")
def ingest_first_tick(spark, sf_dir):
    return op.first_tick(table(spark, sf_dir, "events"), "ts")


@query(
    "ingest_replay_windows",
    """
    WITH w AS (
        SELECT k AS tick, TIMESTAMP '2024-01-01 00:00:00' + k * INTERVAL 5 MINUTE AS window_start,
               TIMESTAMP '2024-01-01 00:00:00' + (k + 1) * INTERVAL 5 MINUTE AS window_end
        FROM (SELECT unnest(generate_series(0, (SELECT CAST(floor((epoch_us(max(ts)) - epoch_us(TIMESTAMP
              '2024-01-01 00:00:00') - 1) / 300000000) AS BIGINT) FROM events))) AS k)
    )
    SELECT w.tick, w.window_start, w.window_end, count(e.event_id) AS n_rows
    FROM w LEFT JOIN events e ON e.ts > w.window_start AND e.ts <= w.window_end
    GROUP BY w.tick, w.window_start, w.window_end
    """,
)
def ingest_replay_windows(spark, sf_dir):
    return op.replay_windows(table(spark, sf_dir, "events"), "ts", datetime(2024, 1, 1), timedelta(minutes=5))


@query(
    "late_rows_report",
    """
    SELECT event_type, count(*) FILTER (WHERE ts <= TIMESTAMP '2024-01-10') AS n_late,
           count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-10') AS n_ahead
    FROM events GROUP BY event_type
    """,
)
def late_rows_report(spark, sf_dir):
    return op.late_report(table(spark, sf_dir, "events"), "ts", WATERMARK, ["event_type"])


LATEST_EVENT_SQL = """
    SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events
    ) WHERE r = 1
    """


@query("ingest_ticks_bronze", LATEST_EVENT_SQL)
def ingest_ticks_bronze(spark, sf_dir):
    store = Store(spark, scratch_path(spark, "store"))
    feed = events_feed("json", ("user_id", "event_type"), timedelta(days=10), "day")
    path = land_by_day(spark, event_lines(spark, sf_dir))
    run_ticks(store, feed, path, latest_event(spark, sf_dir))
    return as_events(store.bronze("events").read())


def latest_event(spark: SparkSession, sf_dir: str) -> datetime:
    return table(spark, sf_dir, "events").agg(F.max("ts").alias("ts")).first()["ts"]


def run_ticks(store: Store, feed: SourceSpec, path: str, latest: datetime) -> None:
    """Bounded ticks until the watermark has passed a time."""
    result = ingest_tick(store, feed, path, start=datetime(2023, 12, 31))
    while result.watermark < latest:
        result = ingest_tick(store, feed, path)


# What the landing files of a feed with faults hold: a time that is none, a line cut off, a row in another day's folder,
# an integer as a decimal, or a row as it should be.
FAULT_SQL = """CASE event_id % 20 WHEN 1 THEN 'bad_time' WHEN 2 THEN 'cut_off' WHEN 3 THEN 'misplaced'
               WHEN 4 THEN 'decimal' ELSE 'none' END"""


@query(
    "landing_malformed",
    f"""
    SELECT event_id, fault NOT IN ('bad_time', 'cut_off', 'misplaced') AND value >= 5 AS is_valid,
           CASE fault WHEN 'bad_time' THEN 'unreadable_time' WHEN 'cut_off' THEN 'unreadable_record'
                      WHEN 'misplaced' THEN 'time_of_another_day'
                      ELSE CASE WHEN value >= 5 THEN '' ELSE 'enough_value' END END AS failed_rules,
           CASE WHEN fault IN ('bad_time', 'cut_off') THEN NULL ELSE user_id END AS user_id
    FROM (SELECT *, {FAULT_SQL} AS fault FROM events)
    """,
)
def landing_malformed(spark, sf_dir):
    """Every landed row is once among the valid or the quarantined ones, whatever is wrong with it."""
    rows = event_texts(spark, sf_dir).withColumn("fault", F.expr(FAULT_SQL))
    faulty = {
        "ts": F.when(F.col("fault") == "bad_time", "soon").otherwise(F.col("ts")),
        "user_id": F.concat(F.when(F.col("fault") != "bad_time", F.col("user_id")), F.when(F.col("fault") == "decimal", ".0").otherwise("")),
    }
    line = F.to_json(F.struct(*[faulty.get(c, F.col(c)).alias(c) for c in EVENT_TYPES]))
    cut = F.when(F.col("fault") == "cut_off", F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    day = F.when(F.col("fault") == "misplaced", F.date_add("ts", 1)).otherwise(F.to_date("ts"))
    path = land_by_day(spark, rows.select(cut.alias("line"), day.cast("string").alias("day")))
    store, feed = Store(spark, scratch_path(spark, "malformed")), events_feed("json", window=timedelta(days=10), day_folder="day")
    run_ticks(store, feed, path, latest_event(spark, sf_dir) + timedelta(days=1))
    refine_source(store, feed, {"enough_value": "value >= 5"})
    number = F.coalesce("event_id", F.regexp_extract("corrupt_record", '"event_id":([0-9]+)', 1).cast("long"))
    bad = quarantined_rows(store, "events").select(
        number.alias("event_id"), F.lit(False).alias("is_valid"), F.array_join("failed_rules", ",").alias("failed_rules"), "user_id"
    )
    good = valid_rows(store, "events").select("event_id", F.lit(True).alias("is_valid"), F.lit("").alias("failed_rules"), "user_id")
    return good.unionByName(bad)


@query(
    "landing_evolved",
    """
    SELECT event_id, ts, user_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN value END AS value,
           CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN props END AS props FROM events
    """,
)
def landing_evolved(spark, sf_dir):
    """A CSV feed that gains a column twice, each time in another order of columns."""
    rows, path = event_texts(spark, sf_dir), scratch_path(spark, "landing-evolved")
    versions = {
        "ts < '2024-01-10'": ["event_id", "ts", "user_id", "event_type"],
        "ts >= '2024-01-10' AND ts < '2024-01-20'": ["value", "ts", "event_type", "event_id", "user_id"],
        "ts >= '2024-01-20'": ["ts", "props", "event_id", "note", "user_id", "value", "event_type"],
    }
    for k, (when, columns) in enumerate(versions.items()):
        part = rows.withColumn("note", F.lit("beside the feed")).filter(when)
        part.select(*columns).write.options(header="true", escape='"').csv(f"{path}/{k}")
    feed = SourceSpec("events", "csv", EVENT_TYPES, ("event_id",), "ts", options={"escape": '"'})
    return as_events(readable(read_landing(spark, feed, path)))


@query("stream_ingest", LATEST_EVENT_SQL)
def stream_ingest_events(spark, sf_dir):
    feed = events_feed("json", ("user_id", "event_type"))
    bronze = ParquetTable(spark, scratch_path(spark, "streamed"), BY_MONTH)
    path = land_events(spark, sf_dir, "json")
    stream_ingest(bronze, feed, path, scratch_path(spark, "stream-state")).awaitTermination()
    return as_events(bronze.read())


def land_in_order(spark: SparkSession, rows: DataFrame, parts: list[str]) -> str:
    """Rows as JSON lines, one file after the other for each of the conditions."""
    path = scratch_path(spark, "landing-parts")
    for k, when in enumerate(parts):
        rows.filter(when).coalesce(1).write.json(f"{path}/{k}")
    return path


def chunk_of(days: str) -> str:
    return f"least(3, floor(({days} - 1) / 8))"


@query("stream_windows", ORACLES["ingest_replay_windows"])
def stream_windows_of_events(spark, sf_dir):
    """The windows of the replay from a stream whose files come one by one, the latest first."""
    rows = event_texts(spark, sf_dir)
    path = land_in_order(spark, rows, [f"{chunk_of('dayofmonth(CAST(ts AS DATE))')} = {k}" for k in (3, 2, 1, 0)])
    windows = ParquetTable(spark, scratch_path(spark, "windows"), BY_DAY)
    stream = landing_stream(spark, events_feed("json"), path, max_files=1)
    start, width = datetime(2024, 1, 1), timedelta(minutes=5)
    stream_windows(stream, "ts", start, width, "60 days", windows, scratch_path(spark, "stream-state")).awaitTermination()
    return op.with_empty_ticks(windows.read().select("tick", "n"), start, width)


@query(
    "stream_late_rows",
    f"""
    WITH e AS (SELECT event_id, ts, list_extract([2, 1, 4, 3], CAST({chunk_of('day(ts)')} AS INTEGER) + 1) AS came FROM events),
    w AS (SELECT came, max(max(ts)) OVER (ORDER BY came ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 DAY AS mark
          FROM e GROUP BY came)
    SELECT event_id, coalesce(ts <= mark, FALSE) AS is_late FROM e JOIN w USING (came)
    """,
)
def stream_late_rows(spark, sf_dir):
    """A stream whose files come out of order: rows ten days or more behind what has been seen are late, none is lost."""
    rows = event_texts(spark, sf_dir)
    path = land_in_order(spark, rows, [f"{chunk_of('dayofmonth(CAST(ts AS DATE))')} = {k}" for k in (1, 0, 3, 2)])
    on_time, late, marks = (ParquetTable(spark, scratch_path(spark, name), BY_BATCH) for name in ("on-time", "late", "marks"))
    stream = landing_stream(spark, events_feed("json"), path, max_files=1)
    state = scratch_path(spark, "stream-state")
    stream_by_lateness(stream, "ts", timedelta(days=10), on_time, late, marks, state).awaitTermination()
    number = F.col("event_id").cast("long").alias("event_id")
    kept = on_time.read().select(number, F.lit(False).alias("is_late"))
    return kept.unionByName(late.read_or_empty(on_time.read().schema).select(number, F.lit(True).alias("is_late")))


# -- keyed operators ---------------------------------------------------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_TIES = ["l_extendedprice", "l_partkey", "l_suppkey"]
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
DEDUP_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) AS r
        FROM {source}
    ) WHERE r = 1
    """
UPSERT_SQL = f"""
    WITH target AS ({DEDUP_SQL.format(source="(SELECT * FROM lineitem WHERE l_shipdate < DATE '1998-01-01')")}),
         source AS ({DEDUP_SQL.format(source="(SELECT * FROM lineitem WHERE l_shipdate >= DATE '1998-01-01')")})
    SELECT * FROM source
    UNION ALL
    SELECT * FROM target t WHERE NOT EXISTS (
        SELECT 1 FROM source s WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)
    """


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)


def old_and_new_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lines shipped before 1998 as a table, later ones as the next slice; both unique on the key."""
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    rows = lines(spark, sf_dir)
    halves = rows.filter(F.col("l_shipdate") < cut), rows.filter(F.col("l_shipdate") >= cut)
    return tuple(op.dedup_latest(half, LINE_KEY, "l_shipdate", LINE_TIES) for half in halves)


@query("dedup_latest_by_key", DEDUP_SQL.format(source="lineitem"))
def dedup_latest_by_key(spark, sf_dir):
    return op.dedup_latest(lines(spark, sf_dir), LINE_KEY, "l_shipdate", LINE_TIES)


@query("upsert_by_key", UPSERT_SQL)
def upsert_by_key(spark, sf_dir):
    target, source = old_and_new_lines(spark, sf_dir)
    return op.upsert(target, source, LINE_KEY)


@query("table_merge", UPSERT_SQL)
def table_merge(spark, sf_dir):
    lines_table = ParquetTable(spark, scratch_path(spark, "lines"), {"year": "int"})
    target, source = (with_partitions(half, "l_shipdate") for half in old_and_new_lines(spark, sf_dir))
    lines_table.overwrite(target)
    lines_table.merge(source, LINE_KEY)
    return lines_table.read().select(*LINE_COLUMNS)


RETURNED_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')
    """


def orders_and_returns(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    returned = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    keys = returned.select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), keys


@query("delete_matched", RETURNED_SQL)
def delete_matched(spark, sf_dir):
    return op.delete_matched(*orders_and_returns(spark, sf_dir), ["o_orderkey"])


@query("table_delete", RETURNED_SQL)
def table_delete(spark, sf_dir):
    target, keys = orders_and_returns(spark, sf_dir)
    orders = ParquetTable(spark, scratch_path(spark, "orders"))
    orders.overwrite(target)
    orders.delete(keys, ["o_orderkey"])
    return orders.read()


@query(
    "append_schema_merge",
    """
    SELECT o_orderkey, o_custkey, CAST(NULL AS DOUBLE) AS o_totalprice FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'
    """,
)
def append_schema_merge(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    done = F.col("o_orderstatus") == "F"
    orders = ParquetTable(spark, scratch_path(spark, "appended"))
    orders.append(rows.filter(done).select("o_orderkey", "o_custkey"))
    orders.append(rows.filter(~done).select("o_orderkey", "o_custkey", "o_totalprice"))
    return orders.read()


# -- types and quality -------------------------------------------------------------------------------------------------


@query(
    "typed_cast_try",
    """
    SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           TRY_CAST(event_type AS INTEGER) AS type_number FROM events
    """,
)
def typed_cast_try(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), F.col("event_type").alias("type_number")
    )
    return cast_columns(raw, {"k": "INT", "type_number": "INT"})


LINE_RULES = {
    "enough_quantity": "l_quantity >= 5",
    "fair_discount": "l_discount <= 0.09",
    "shipped_after_order": "l_shipdate > o_orderdate",
}
LINE_RULES_JOIN = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
ALL_LINE_RULES = " AND ".join(LINE_RULES.values())
CHECKED = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount"]


def ordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [*CHECKED, "l_shipdate", "l_returnflag", "l_extendedprice"]
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_custkey", "o_totalprice"
    )
    return table(spark, sf_dir, "lineitem").select(*columns).join(orders, "l_orderkey")


@query("quality_valid", f"SELECT {', '.join(CHECKED)} {LINE_RULES_JOIN} WHERE {ALL_LINE_RULES}")
def quality_valid(spark, sf_dir):
    valid, _ = op.split_by_rules(ordered_lines(spark, sf_dir), LINE_RULES)
    return valid.select(*CHECKED)


@query(
    "quality_quarantine",
    f"""
    SELECT {', '.join(CHECKED)}, concat_ws(',',
        {', '.join(f"CASE WHEN {rule} THEN NULL ELSE '{name}' END" for name, rule in LINE_RULES.items())}
    ) AS failed_rules
    {LINE_RULES_JOIN} WHERE NOT ({ALL_LINE_RULES})
    """,
)
def quality_quarantine(spark, sf_dir):
    _, quarantine = op.split_by_rules(ordered_lines(spark, sf_dir), LINE_RULES)
    return quarantine.select(*CHECKED, F.array_join("failed_rules", ",").alias("failed_rules"))


def labeled_documents(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", how)


@query(
    "quality_null_policy",
    """
    WITH d AS (SELECT quality IN (0, 1) AS ok FROM documents LEFT JOIN labels USING (doc_id))
    SELECT 'fail' AS null_policy, count(*) FILTER (WHERE ok) AS n_valid,
           count(*) FILTER (WHERE NOT coalesce(ok, FALSE)) AS n_quarantined FROM d
    UNION ALL
    SELECT 'drop', count(*) FILTER (WHERE ok), count(*) FILTER (WHERE NOT ok) FROM d
    """,
)
def quality_null_policy(spark, sf_dir):
    rows = labeled_documents(spark, sf_dir, "left").select("doc_id", "quality")

    def counts(policy: str) -> DataFrame:
        valid, quarantine = op.split_by_rules(rows, {"known_quality": "quality IN (0, 1)"}, policy)
        sides = valid.select(F.lit(True).alias("ok")).unionByName(quarantine.select(F.lit(False).alias("ok")))
        return sides.agg(
            F.first(F.lit(policy)).alias("null_policy"),
            F.count_if("ok").alias("n_valid"),
            F.count_if(~F.col("ok")).alias("n_quarantined"),
        )

    return counts("fail").unionByName(counts("drop"))


@query(
    "rule_report",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS rule, count(*) AS n_rows, count(*) FILTER (WHERE NOT ({rule})) AS n_violations,
            count(*) FILTER (WHERE ({rule}) IS NULL) AS n_undecided {LINE_RULES_JOIN}"""
        for name, rule in LINE_RULES.items()
    ),
)
def rule_report(spark, sf_dir):
    return op.rule_report(ordered_lines(spark, sf_dir), LINE_RULES)


UNIQUE_CHECKS = {"lineitem": LINE_KEY, "orders": ["o_orderkey"], "events": ["event_id"]}


@query(
    "key_uniqueness_check",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
            count(*) FILTER (WHERE n > 1) AS n_repeated_keys, max(n) AS max_rows_per_key,
            count(*) FILTER (WHERE n > 1) = 0 AS is_unique
            FROM (SELECT count(*) AS n FROM {name} GROUP BY {', '.join(keys)})"""
        for name, keys in UNIQUE_CHECKS.items()
    ),
)
def key_uniqueness_check(spark, sf_dir):
    checks = [
        op.check_unique(table(spark, sf_dir, name).select(*keys), keys).select(F.lit(name).alias("table_name"), "*")
        for name, keys in UNIQUE_CHECKS.items()
    ]
    return reduce(DataFrame.unionByName, checks)


@query(
    "not_null_check",
    """
    WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))
    SELECT 'doc_id' AS "column", count(*) FILTER (WHERE doc_id IS NULL) AS n_null FROM d
    UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL) FROM d
    UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL) FROM d
    """,
)
def not_null_check(spark, sf_dir):
    return op.check_not_null(labeled_documents(spark, sf_dir, "left"), ["doc_id", "quality", "toxic"])


SUBSET_CHECKS = {
    "lines_of_orders": ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    "labels_of_documents": ("labels", "doc_id", "documents", "doc_id"),
    "orders_with_lines": ("orders", "o_orderkey", "lineitem", "l_orderkey"),
}


@query(
    "subset_check",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS check_name, count(*) AS n_rows,
            count(*) FILTER (WHERE {key} NOT IN (SELECT {other_key} FROM {other})) AS n_orphans,
            count(*) FILTER (WHERE {key} NOT IN (SELECT {other_key} FROM {other})) = 0 AS is_subset FROM {rows}"""
        for name, (rows, key, other, other_key) in SUBSET_CHECKS.items()
    ),
)
def subset_check(spark, sf_dir):
    def check(name: str, rows: str, key: str, other: str, other_key: str) -> DataFrame:
        ids = table(spark, sf_dir, rows).select(F.col(key).alias("id"))
        reference = table(spark, sf_dir, other).select(F.col(other_key).alias("id"))
        return op.check_subset(ids, reference, ["id"]).select(F.lit(name).alias("check_name"), "*")

    return reduce(DataFrame.unionByName, [check(name, *args) for name, args in SUBSET_CHECKS.items()])


@query(
    "split_conservation",
    f"""
    SELECT count(*) AS n_input, count(*) FILTER (WHERE {ALL_LINE_RULES}) AS n_valid,
           count(*) FILTER (WHERE NOT ({ALL_LINE_RULES})) AS n_quarantined, TRUE AS is_conserved {LINE_RULES_JOIN}
    """,
)
def split_conservation(spark, sf_dir):
    return op.check_split(ordered_lines(spark, sf_dir), LINE_RULES)


EVENT_RULES = {
    "valid_user": "user_id IS NOT NULL",
    "enough_value": "value BETWEEN 5 AND 60",
    "known_type": "event_type IN ('click', 'view', 'purchase', 'signup')",
}
VIOLATED = ", ".join(f"CASE WHEN {rule} THEN NULL ELSE '{name}' END" for name, rule in EVENT_RULES.items())


@query(
    "silver_refine",
    f"""
    SELECT event_id, {' AND '.join(f'({rule})' for rule in EVENT_RULES.values())} AS is_valid,
           concat_ws(',', {VIOLATED}) AS failed_rules FROM events
    """,
)
def silver_refine(spark, sf_dir):
    """Two ticks into bronze, each followed by a refinement of what it brought."""
    store = Store(spark, scratch_path(spark, "refined"))
    feed, path = events_feed("json", window=timedelta(days=15), day_folder="day"), land_by_day(spark, event_lines(spark, sf_dir))
    latest = latest_event(spark, sf_dir)
    result = ingest_tick(store, feed, path, start=datetime(2023, 12, 31))
    refine_source(store, feed, EVENT_RULES)
    rest = -((result.watermark - latest) // feed.window)
    ingest_tick(store, feed, path, windows=max(1, rest))
    refine_source(store, feed, EVENT_RULES)
    rows = store.silver("events").read()
    return rows.select("event_id", "is_valid", F.array_join("failed_rules", ",").alias("failed_rules"))


# -- features and assembly ---------------------------------------------------------------------------------------------


@query(
    "session_features",
    """
    SELECT user_id, event_type, CAST(min(ts) AS DATE) AS session_date, round(avg(value), 6) AS mean_value,
           round(CASE WHEN avg(value) <> 0 THEN stddev_samp(value) / avg(value) END, 6) AS value_cv, count(*) AS n
    FROM events GROUP BY user_id, event_type
    """,
)
def session_features(spark, sf_dir):
    features = op.session_features(
        table(spark, sf_dir, "events"),
        ["user_id", "event_type"],
        "ts",
        {"mean_value": "value"},
        {"value_cv": "value"},
        count="n",
    )
    return features.withColumns({"mean_value": rounded("mean_value"), "value_cv": rounded("value_cv")})


@query(
    "session_features_by_date",
    """
    SELECT user_id, CAST(ts AS DATE) AS session_date, round(avg(value), 6) AS mean_value,
           round(CASE WHEN avg(value) <> 0 THEN stddev_samp(value) / avg(value) END, 6) AS value_cv, count(*) AS n
    FROM events GROUP BY user_id, CAST(ts AS DATE)
    """,
)
def session_features_by_date(spark, sf_dir):
    features = op.session_features(
        table(spark, sf_dir, "events"),
        ["user_id"],
        "ts",
        {"mean_value": "value"},
        {"value_cv": "value"},
        count="n",
        split_by_date=True,
    )
    return features.withColumns({"mean_value": rounded("mean_value"), "value_cv": rounded("value_cv")})


ENTITY_SQL = """
    e AS (SELECT user_id, CAST(ts AS DATE) AS event_date, event_type, value FROM events),
    p AS (SELECT user_id, event_date, bool_or(event_type = 'signup') AS has_signup,
                 bool_or(event_type = 'click') AS has_click, bool_or(event_type = 'view') AS has_view,
                 bool_or(event_type = 'purchase') AS has_purchase
          FROM e GROUP BY user_id, event_date)
    """


def entity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("event_date"), "event_type", "value")


def of_type(events: DataFrame, kind: str) -> DataFrame:
    return events.filter(F.col("event_type") == kind)


def side_features(events: DataFrame, kind: str) -> DataFrame:
    return of_type(events, kind).groupBy(*ENTITY).agg(F.sum("value").alias(f"{kind}_value"))


def signups(events: DataFrame) -> DataFrame:
    return of_type(events, "signup").groupBy(*ENTITY).agg(F.count(F.lit(1)).alias("n_signups"))


def source_rows(events: DataFrame, kinds=SIDES) -> dict[str, DataFrame]:
    return {kind: of_type(events, kind).select(*ENTITY) for kind in kinds}


@query(
    "complete_entities",
    f"WITH {ENTITY_SQL} SELECT user_id, event_date FROM p WHERE has_signup AND has_click AND has_view AND has_purchase",
)
def complete_entities(spark, sf_dir):
    return op.complete_ids(source_rows(entity_events(spark, sf_dir), ("signup", *SIDES)), ENTITY)


@query(
    "assemble_incremental",
    f"""
    WITH {ENTITY_SQL}, v AS (
        SELECT user_id, event_date, count(*) FILTER (WHERE event_type = 'signup') AS n_signups,
               sum(value) FILTER (WHERE event_type = 'click') AS click_value,
               sum(value) FILTER (WHERE event_type = 'view') AS view_value,
               sum(value) FILTER (WHERE event_type = 'purchase') AS purchase_value
        FROM e GROUP BY user_id, event_date)
    SELECT user_id, event_date, n_signups, round(click_value, 4) AS click_value, round(view_value, 4) AS view_value,
           round(purchase_value, 4) AS purchase_value
    FROM v JOIN p USING (user_id, event_date)
    WHERE has_signup AND has_click AND has_view AND has_purchase AND event_date >= DATE '2024-01-10'
    """,
)
def assemble_incremental(spark, sf_dir):
    """All sources are one table: it is read once for the rows, and once for those that were complete before."""
    events = entity_events(spark, sf_dir)
    before = events.filter(F.col("event_date") < F.lit(WATERMARK.date()))
    already = op.complete_tagged(before, ENTITY, "event_type", ("signup", *SIDES))
    sources = {"signup": {"n_signups": (F.count, "event_type")}, **{k: {f"{k}_value": (F.sum, "value")} for k in SIDES}}
    rows = op.assemble_tagged(events, ENTITY, "event_type", sources, already)
    return rows.select(*ENTITY, "n_signups", *[rounded(f"{k}_value", 4).alias(f"{k}_value") for k in SIDES])


@query(
    "assemble_sources",
    f"""
    WITH {ENTITY_SQL}, r AS (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS k FROM events)
    SELECT user_id, event_date, max(CASE WHEN event_type = 'signup' THEN event_id END) AS signup_event,
           max(CASE WHEN event_type = 'click' THEN event_id END) AS click_event,
           max(CASE WHEN event_type = 'view' THEN event_id END) AS view_event,
           max(CASE WHEN event_type = 'purchase' THEN event_id END) AS purchase_event
    FROM (SELECT *, CAST(ts AS DATE) AS event_date FROM r WHERE k = 1) JOIN p USING (user_id, event_date)
    WHERE has_signup AND has_click AND has_view AND has_purchase GROUP BY user_id, event_date
    """,
)
def assemble_sources(spark, sf_dir):
    """Separate sources, of each the latest row of an entity."""
    events = table(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts"))

    def source(kind: str) -> DataFrame:
        return of_type(events, kind).select(*ENTITY, F.col("ts").alias(f"{kind}_ts"), F.col("event_id").alias(f"{kind}_event"))

    latest = {"_base": "signup_ts", **{kind: f"{kind}_ts" for kind in SIDES}}
    rows = op.assemble(source("signup"), {kind: source(kind) for kind in SIDES}, ENTITY, latest=latest)
    return rows.select(*ENTITY, *[f"{kind}_event" for kind in ("signup", *SIDES)])


OVERDUE_SQL = f"""
    WITH {ENTITY_SQL}, b AS (SELECT user_id, event_date, count(*) AS n_signups FROM e WHERE event_type = 'signup'
                             GROUP BY user_id, event_date)
    SELECT user_id, event_date, n_signups, NOT has_click AS missing_click, NOT has_view AS missing_view,
           {{purchase}} AS missing_purchase
    FROM b JOIN p USING (user_id, event_date)
    WHERE event_date <= (SELECT max(event_date) FROM b) - 3
    """


def overdue_signups(events: DataFrame, arrived=SIDES) -> DataFrame:
    none = of_type(events, "").select(*ENTITY)
    sides = {kind: rows if kind in arrived else none for kind, rows in source_rows(events).items()}
    overdue = op.overdue_incomplete(signups(events), sides, ENTITY, "event_date", 3)
    return overdue.drop("quarantine_timestamp")


@query(
    "overdue_incomplete",
    OVERDUE_SQL.format(purchase="NOT has_purchase") + " AND NOT (has_click AND has_view AND has_purchase)",
)
def overdue_incomplete(spark, sf_dir):
    return overdue_signups(entity_events(spark, sf_dir))


@query(
    "rescue_from_quarantine",
    OVERDUE_SQL.format(purchase="TRUE") + " AND NOT (has_click AND has_view AND has_purchase)",
)
def rescue_from_quarantine(spark, sf_dir):
    """Quarantined while no purchase had arrived; those that the purchases complete are released."""
    events = entity_events(spark, sf_dir)
    waiting = overdue_signups(events, arrived=("click", "view"))
    complete = op.complete_ids(source_rows(events, ("signup", *SIDES)), ENTITY)
    return op.delete_matched(waiting, complete, ENTITY)


@query(
    "rescued_count",
    f"""
    SELECT count(*) AS n FROM ({OVERDUE_SQL.format(purchase="TRUE")} AND has_click AND has_view AND has_purchase)
    """,
)
def rescued_count(spark, sf_dir):
    events = entity_events(spark, sf_dir)
    waiting = overdue_signups(events, arrived=("click", "view"))
    complete = op.complete_ids(source_rows(events, ("signup", *SIDES)), ENTITY)
    return op.matched_count(waiting, complete, ENTITY)


@query(
    "reassemble_ticks",
    f"""
    WITH {ENTITY_SQL},
    f AS (SELECT user_id, event_date, 1 AS tick, has_click, has_view, has_purchase FROM p WHERE has_signup AND event_date < DATE '2024-01-10'
          UNION ALL SELECT user_id, event_date, 2, has_click, has_view, has_purchase FROM p WHERE has_signup),
    o AS (SELECT *, has_click AND has_view AND has_purchase AS whole,
                 event_date <= max(event_date) OVER (PARTITION BY tick) - 3 AS overdue FROM f)
    SELECT user_id, event_date, CASE WHEN whole THEN 'assembled' ELSE 'waiting' END AS state, min(tick) AS since,
           min(CASE WHEN whole THEN NULL ELSE (NOT has_click) END) AS missing_click,
           min(CASE WHEN whole THEN NULL ELSE (NOT has_view) END) AS missing_view,
           min(CASE WHEN whole THEN NULL ELSE (NOT has_purchase) END) AS missing_purchase
    FROM o WHERE whole OR overdue GROUP BY user_id, event_date, whole
    """,
)
def reassemble_ticks(spark, sf_dir):
    """Two ticks of assembly and waiting room: the first before a day, the second over everything."""
    store, plan = Store(spark, scratch_path(spark, "reassembled")), Assembly(ENTITY, "arrived")
    events = entity_events(spark, sf_dir)
    for tick, now in enumerate((WATERMARK, datetime(2030, 1, 1)), 1):
        seen = events.filter(F.col("event_date") < F.lit(now.date()))
        base = signups(seen).withColumns({"arrived": F.col("event_date"), "since": F.lit(tick)})
        reassemble(store, base, {kind: side_features(seen, kind) for kind in SIDES}, plan, 3, now)
    missing = [f"missing_{kind}" for kind in SIDES]
    done = store.gold("assembled").read().select(*ENTITY, F.lit("assembled").alias("state"), "since", *[F.lit(None).cast("boolean").alias(m) for m in missing])
    return done.unionByName(store.gold("inference_quarantine").read().select(*ENTITY, F.lit("waiting").alias("state"), "since", *missing))


@query(
    "fan_out_report",
    """
    SELECT event_type AS source, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_ids, max(n) AS max_rows_per_id
    FROM (SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('click', 'view', 'purchase')
          GROUP BY event_type, user_id, CAST(ts AS DATE))
    GROUP BY event_type
    """,
)
def fan_out_report(spark, sf_dir):
    return op.fan_out_report(source_rows(entity_events(spark, sf_dir)), ENTITY)


@query(
    "asof_features",
    """
    WITH v AS (SELECT user_id, ts, max(value) AS view_value FROM events WHERE event_type = 'view' GROUP BY user_id, ts)
    SELECT p.event_id, p.user_id, p.ts, v.ts AS view_ts, v.view_value
    FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts
    """,
)
def asof_features(spark, sf_dir):
    """Every purchase with the user's latest view on or before it."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    purchases = of_type(events, "purchase").select("event_id", "user_id", "ts")
    views = of_type(events, "view").select("user_id", F.col("ts").alias("view_ts"), F.col("value").alias("view_value"))
    return op.asof_join(purchases, views, ["user_id"], "ts", "view_ts", ["view_ts", "view_value"])


# -- training rows -----------------------------------------------------------------------------------------------------


@query(
    "label_antileakage",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(o_orderdate AS DATE) AS observed, CAST(l_shipdate AS DATE)
           AS available {LINE_RULES_JOIN} WHERE l_shipdate > o_orderdate
    """,
)
def label_antileakage(spark, sf_dir):
    clean = op.antileakage(ordered_lines(spark, sf_dir), "l_shipdate", "o_orderdate")
    return clean.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.to_date("o_orderdate").alias("observed"), F.to_date("l_shipdate").alias("available"),
    )


TRAINING_SQL = """
    SELECT c_custkey, c_mktsegment, c_acctbal, n_orders, last_order, mean_price, mean_quantity,
           quantity_cv, n_lines, available, returned
    FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, CAST(max(o_orderdate) AS DATE) AS last_order,
                      round(avg(o_totalprice), 6) AS mean_price FROM orders GROUP BY o_custkey) o
           ON o_custkey = c_custkey
    LEFT JOIN (SELECT o_custkey AS line_custkey, round(avg(l_quantity), 6) AS mean_quantity,
                      round(CASE WHEN avg(l_quantity) <> 0 THEN stddev_samp(l_quantity) / avg(l_quantity) END, 6)
                          AS quantity_cv, count(*) AS n_lines
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey
               WHERE l_quantity >= 5 AND l_discount <= 0.09 GROUP BY o_custkey) f ON line_custkey = c_custkey
    LEFT JOIN (SELECT o_custkey AS label_custkey, CAST(max(l_shipdate) AS DATE) AS available,
                      CAST(max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INTEGER) AS returned
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey
               WHERE l_shipdate > o_orderdate GROUP BY o_custkey) g ON label_custkey = c_custkey
    """


def customer_sides(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Order and line features per customer, and a label from lines shipped after their order."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_totalprice")
    by_order = orders.groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.to_date(F.max("o_orderdate")).alias("last_order"),
        rounded(F.avg("o_totalprice")).alias("mean_price"),
    )
    rows = ordered_lines(spark, sf_dir).withColumnRenamed("o_custkey", "c_custkey")
    checks = {k: v for k, v in LINE_RULES.items() if k != "shipped_after_order"}
    valid, _ = op.split_by_rules(rows, checks)
    by_line = op.session_features(
        valid, ["c_custkey"], "l_shipdate", {"mean_quantity": "l_quantity"}, {"quantity_cv": "l_quantity"}, "n_lines"
    )
    by_line = by_line.withColumns({"mean_quantity": rounded("mean_quantity"), "quantity_cv": rounded("quantity_cv")})
    labels = op.antileakage(rows, "l_shipdate", "o_orderdate").groupBy("c_custkey").agg(
        F.to_date(F.max("l_shipdate")).alias("available"),
        F.max((F.col("l_returnflag") == "R").cast("int")).alias("returned"),
    )
    return {"orders": by_order, "lines": by_line}, labels


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")


@query("training_table", TRAINING_SQL)
def training_table(spark, sf_dir):
    sides, labels = customer_sides(spark, sf_dir)
    # Labels were filtered before the aggregate; they have no observation column to compare with.
    return op.training_table(customers(spark, sf_dir), sides, labels, ["c_custkey"], ["session_date"], available="available")


@query(
    "training_table_repeat_ids",
    """
    SELECT o_custkey, CAST(o_orderdate AS DATE) AS snapshot_date, n_orders, label_available_date, late
    FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders) b
    LEFT JOIN (SELECT o_custkey AS k, count(*) AS n_orders FROM orders GROUP BY o_custkey) s ON k = o_custkey
    LEFT JOIN (SELECT o_custkey AS lk, CAST(o_orderdate AS DATE) AS ld, max(CAST(l_shipdate AS DATE)) AS label_available_date,
                      CAST(max(CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END) AS INTEGER) AS late
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL) l
           ON lk = o_custkey AND ld = o_orderdate AND label_available_date > ld
    """,
)
def training_table_repeat_ids(spark, sf_dir):
    """A customer has a row for each day with an order; the label of a day is not that of another day."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("snapshot_date"))
    sides = {"orders": orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))}
    rows = ordered_lines(spark, sf_dir).withColumn("snapshot_date", F.to_date("o_orderdate"))
    labels = rows.groupBy("o_custkey", "snapshot_date").agg(
        F.max(F.to_date("l_shipdate")).alias("label_available_date"),
        F.max((F.col("l_quantity") > 45).cast("int")).alias("late"),
    )
    return op.training_table(orders.distinct(), sides, labels, ["o_custkey"])


@query(
    "training_table_missing_side",
    """
    SELECT c_custkey, c_mktsegment, CAST(NULL AS BIGINT) AS n_orders, CAST(NULL AS DOUBLE) AS mean_price,
           quality_date AS label_available_date, status
    FROM customer LEFT JOIN (
        SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS quality_date, max(o_orderstatus) AS status
        FROM orders GROUP BY o_custkey HAVING CAST(max(o_orderdate) AS DATE) > DATE '2000-01-01'
    ) ON o_custkey = c_custkey
    """,
)
def training_table_missing_side(spark, sf_dir):
    """A side table that does not exist yet contributes its declared columns as NULL."""
    absent = ParquetTable(spark, scratch_path(spark, "absent"))
    side = absent.read_or_empty(StructType.fromDDL("c_custkey BIGINT, n_orders BIGINT, mean_price DOUBLE"))
    labels = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.to_date(F.max("o_orderdate")).alias("label_available_date"),
            F.max("o_orderstatus").alias("status"),
        )
        .withColumn("snapshot_date", F.lit("2000-01-01").cast("date"))
    )
    base = customers(spark, sf_dir).drop("c_acctbal")
    return op.training_table(base, {"orders": side}, labels, ["c_custkey"])


SPLIT_SQL = """
    WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done,
                      o_orderkey FROM orders),
    s AS (SELECT day - DATE '1970-01-01' AS days, * FROM d),
    q AS (SELECT DATE '1970-01-01' + CAST(floor(round(quantile_cont(CAST(days AS DOUBLE) * 86400, 0.7)) / 86400) AS
                 INTEGER) AS train_end,
                 DATE '1970-01-01' + CAST(floor(round(quantile_cont(CAST(days AS DOUBLE) * 86400, 0.9)) / 86400) AS
                 INTEGER) AS val_end FROM s),
    t AS (SELECT o_orderkey, day, done, CASE WHEN day <= train_end THEN 'train' WHEN day <= val_end THEN 'val'
                 ELSE 'test' END AS split FROM d, q)
    """


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("done", (F.col("o_orderstatus") == "F").cast("int"))


@query("temporal_split", f"WITH {SPLIT_SQL.split('WITH', 1)[1]} SELECT o_orderkey, split FROM t")
def temporal_split(spark, sf_dir):
    return op.temporal_split(dated_orders(spark, sf_dir), "o_orderdate").select("o_orderkey", "split")


@query(
    "temporal_split_summary",
    f"""{SPLIT_SQL} SELECT split, count(*) AS n, min(day) AS min_date, max(day) AS max_date,
        round(avg(done), 6) AS prevalence FROM t GROUP BY split""",
)
def temporal_split_summary(spark, sf_dir):
    split = op.temporal_split(dated_orders(spark, sf_dir), "o_orderdate")
    return op.split_summary(split, "o_orderdate", "done").withColumn("prevalence", rounded("prevalence"))


@query(
    "unlabeled_excluded",
    """
    SELECT count(quality) AS n_labeled, count(*) - count(quality) AS n_excluded
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def unlabeled_excluded(spark, sf_dir):
    return op.label_coverage(labeled_documents(spark, sf_dir, "left"), "quality")


# -- preprocessing -----------------------------------------------------------------------------------------------------


@query(
    "impute_median_mode",
    """
    WITH d AS (SELECT doc_id, CASE WHEN quality IS NOT NULL THEN n_chars END AS n_chars,
                      CASE WHEN quality IS NOT NULL THEN lang END AS lang
               FROM documents LEFT JOIN labels USING (doc_id)),
    m AS (SELECT lang AS common FROM d WHERE lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1)
    SELECT doc_id, coalesce(CAST(n_chars AS DOUBLE), (SELECT median(n_chars) FROM d)) AS n_chars,
           coalesce(lang, (SELECT common FROM m)) AS lang FROM d
    """,
)
def impute_median_mode(spark, sf_dir):
    """Length and language are known for labelled documents only."""
    rows = labeled_documents(spark, sf_dir, "left")
    known = F.col("quality").isNotNull()
    rows = rows.select("doc_id", F.when(known, F.col("n_chars")).alias("n_chars"), F.when(known, F.col("lang")).alias("lang"))
    return op.impute(rows, op.impute_values(rows, ["n_chars"], ["lang"]))


@query(
    "exact_medians",
    """
    SELECT 'l_extendedprice' AS "column", median(l_extendedprice) AS median FROM lineitem
    UNION ALL SELECT 'l_quantity', median(l_quantity) FROM lineitem
    UNION ALL SELECT 'l_discount', median(l_discount) FROM lineitem
    UNION ALL SELECT 'l_tax', median(l_tax) FROM lineitem
    """,
)
def exact_medians(spark, sf_dir):
    """Columns of many and of few distinct values, together."""
    columns = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    medians = op.exact_medians(table(spark, sf_dir, "lineitem"), columns)
    return spark.createDataFrame(list(medians.items()), "column STRING, median DOUBLE")


@query(
    "ordinal_encode",
    """
    SELECT o_orderkey, o_orderpriority, CAST(CASE WHEN o_orderstatus = 'P' THEN -1 ELSE
           (SELECT count(DISTINCT x.o_orderpriority) FROM orders x WHERE x.o_orderpriority < o.o_orderpriority) END
           AS INTEGER) AS code
    FROM orders o
    """,
)
def ordinal_encode(spark, sf_dir):
    """Codes learned from all orders; a priority that was never seen stands in for those still pending."""
    orders = table(spark, sf_dir, "orders")
    known = op.category_table(orders, "o_orderpriority")
    shown = F.when(F.col("o_orderstatus") == "P", "unseen").otherwise(F.col("o_orderpriority"))
    coded = op.ordinal_encode(orders.withColumn("shown", shown), "shown", "code", known)
    return coded.select("o_orderkey", "o_orderpriority", "code")


@query(
    "standardize",
    """
    SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) /
           (SELECT CASE WHEN stddev_pop(c_acctbal) = 0 THEN 1 ELSE stddev_pop(c_acctbal) END FROM customer), 6)
           AS c_acctbal FROM customer
    """,
)
def standardize(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return op.standardize(rows, ["c_acctbal"]).withColumn("c_acctbal", rounded("c_acctbal"))


@query(
    "class_weights",
    """
    SELECT quality, n, round(CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n), 6) AS weight
    FROM (SELECT quality, count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY quality)
    """,
)
def class_weights(spark, sf_dir):
    return op.class_weights(table(spark, sf_dir, "labels"), "quality").withColumn("weight", rounded("weight"))


# -- metrics -----------------------------------------------------------------------------------------------------------

CURVE_SQL = """
    s AS (SELECT CAST(n_chars AS DOUBLE) AS score, quality AS label FROM documents JOIN labels USING (doc_id)
          WHERE quality IS NOT NULL),
    g AS (SELECT score, CAST(sum(label) AS BIGINT) AS pos, count(*) AS n FROM s GROUP BY score),
    c AS (SELECT score, pos, n, CAST(sum(pos) OVER w AS BIGINT) AS cum_pos, CAST(sum(n) OVER w AS BIGINT) AS cum_n,
                 CAST(sum(pos) OVER () AS BIGINT) AS all_pos, CAST(sum(n) OVER () AS BIGINT) AS all_n
          FROM g WINDOW w AS (ORDER BY score DESC))
    """


@query("score_curve", f"WITH {CURVE_SQL} SELECT score, pos, n, cum_pos, cum_n, all_pos, all_n FROM c")
def score_curve(spark, sf_dir):
    return op.score_curve(labeled_documents(spark, sf_dir), "n_chars", "quality")


@query(
    "average_precision",
    f"WITH {CURVE_SQL} SELECT round(sum(cum_pos * 1.0 / cum_n * pos) / sum(pos), 6) AS auc_pr FROM c",
)
def average_precision(spark, sf_dir):
    scored = op.average_precision(labeled_documents(spark, sf_dir), "n_chars", "quality")
    return scored.select(rounded("auc_pr").alias("auc_pr"))


@query(
    "roc_auc",
    f"""WITH {CURVE_SQL} SELECT round(sum((n - pos) * (cum_pos - pos / 2.0)) / (CAST(sum(pos) AS DOUBLE) *
        sum(n - pos)), 6) AS auc_roc FROM c""",
)
def roc_auc(spark, sf_dir):
    scored = op.roc_auc(labeled_documents(spark, sf_dir), "n_chars", "quality")
    return scored.select(rounded("auc_roc").alias("auc_roc"))


@query(
    "optimal_threshold",
    f"""
    WITH {CURVE_SQL}, f AS (SELECT score AS threshold, CASE WHEN cum_pos = 0 THEN 0.0 ELSE
        2 * (cum_pos / CAST(cum_n AS DOUBLE)) * (cum_pos / CAST(all_pos AS DOUBLE)) /
        (cum_pos / CAST(cum_n AS DOUBLE) + cum_pos / CAST(all_pos AS DOUBLE) + 1e-9) END AS f1 FROM c)
    SELECT threshold, round(f1, 6) AS f1 FROM f ORDER BY f.f1 DESC, threshold LIMIT 1
    """,
)
def optimal_threshold(spark, sf_dir):
    best = op.optimal_threshold(labeled_documents(spark, sf_dir), "n_chars", "quality")
    return best.select("threshold", rounded("f1").alias("f1"))


CUT_SQL = """
    SELECT {columns} tp, fp, fn, tn, round(coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0), 6) AS precision,
           round(coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0), 6) AS recall,
           round(coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0), 6) AS f1,
           tp + fp + fn + tn AS n, round((tp + fn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS prevalence
    FROM (SELECT {columns} count(*) FILTER (WHERE n_chars >= {cut} AND quality = 1) AS tp,
                 count(*) FILTER (WHERE n_chars >= {cut} AND quality <> 1) AS fp,
                 count(*) FILTER (WHERE n_chars < {cut} AND quality = 1) AS fn,
                 count(*) FILTER (WHERE n_chars < {cut} AND quality <> 1) AS tn
          FROM documents JOIN labels USING (doc_id) {rest})
    """
RATIOS = ("precision", "recall", "f1", "prevalence")


@query("classification_metrics", CUT_SQL.format(columns="", cut=1000, rest=""))
def classification_metrics(spark, sf_dir):
    metrics = op.classification_metrics(labeled_documents(spark, sf_dir), "n_chars", "quality", 1000.0)
    return metrics.withColumns({c: rounded(c) for c in RATIOS})


@query(
    "grid_best",
    "WITH m AS ("
    + CUT_SQL.format(
        columns="point, cut,",
        cut="cut",
        rest=", (VALUES (0, 100), (1, 1000), (2, 2000), (3, 5000)) v(point, cut) GROUP BY point, cut",
    )
    + ") SELECT point, CAST(cut AS DOUBLE) AS cut, f1 FROM m ORDER BY f1 DESC, point LIMIT 1",
)
def grid_best(spark, sf_dir):
    """F1 of four fixed thresholds in one pass, then the best of them."""
    cuts = F.explode(F.array(*[F.struct(F.lit(i).alias("point"), F.lit(float(c)).alias("cut")) for i, c in enumerate((100, 1000, 2000, 5000))]))
    rows = labeled_documents(spark, sf_dir).select("n_chars", "quality", cuts.alias("g")).select("*", "g.*")
    metrics = op.classification_metrics(rows, "n_chars", "quality", "cut", ["point", "cut"])
    return op.best_of_grid(metrics.withColumn("f1", rounded("f1")).select("point", "cut", "f1"), "f1", "point")


@query(
    "promotion_decision",
    """
    WITH r AS (SELECT doc_id, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)),
    s AS (SELECT 'by_length' AS scorer, CAST(n_chars AS DOUBLE) AS score, quality AS label FROM r
          UNION ALL SELECT 'by_id', CAST(doc_id AS DOUBLE), quality FROM r
          UNION ALL SELECT 'by_length_clean_first', CAST(n_chars - 1000000 * toxic AS DOUBLE), quality FROM r),
    g AS (SELECT scorer, score, sum(label) AS pos, count(*) AS n FROM s WHERE score IS NOT NULL AND label IS NOT NULL
          GROUP BY scorer, score),
    c AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(n) OVER w AS cum_n FROM g
          WINDOW w AS (PARTITION BY scorer ORDER BY score DESC)),
    m AS (SELECT scorer, CAST(sum(cum_pos * 1.0 / cum_n * pos) / sum(pos) AS DOUBLE) AS auc_pr,
                 sum((n - pos) * (cum_pos - pos / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(n - pos)) AS auc_roc
          FROM c GROUP BY scorer)
    SELECT scorer, round(auc_pr, 6) AS auc_pr, round(auc_roc, 6) AS auc_roc,
           CASE WHEN NOT (auc_pr >= 0.35 AND auc_roc >= 0.52) THEN 'rejected_gate'
                WHEN NOT auc_pr > (SELECT auc_pr FROM m WHERE scorer = 'by_length') THEN 'rejected_champion'
                ELSE 'champion' END AS decision
    FROM m
    """,
)
def promotion_decision(spark, sf_dir):
    """Three scorers of one label; the champion in office scores by length."""
    scorers = {
        "by_length": F.col("n_chars"),
        "by_id": F.col("doc_id"),
        "by_length_clean_first": F.col("n_chars") - 1_000_000 * F.col("toxic"),
    }
    pairs = F.explode(
        F.array(*[F.struct(F.lit(n).alias("scorer"), s.cast("double").alias("score")) for n, s in scorers.items()])
    )
    rows = labeled_documents(spark, sf_dir).select("quality", pairs.alias("s")).select("quality", "s.*")
    metrics = op.ranking_metrics(rows, "score", "quality", ["scorer"])
    champion = metrics.filter(F.col("scorer") == "by_length")
    decided = op.promotion_decisions(metrics, champion, 0.35, 0.52)
    return decided.select("scorer", rounded("auc_pr").alias("auc_pr"), rounded("auc_roc").alias("auc_roc"), "decision")


# -- scoring and training ----------------------------------------------------------------------------------------------

NEW_SCORES_SQL = """
    SELECT c_custkey, round(p, 4) AS frailty_prob, CAST(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS
           frailty_pred, CAST(0.5 AS DOUBLE) AS threshold, CAST(1 AS INTEGER) AS champion_version
    FROM (SELECT c_custkey, (c_acctbal + 1000) / 11000 AS p FROM customer) c
    WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')
    """


def new_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an urgent order have been scored before."""
    urgent = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    scored = urgent.select(F.col("o_custkey").alias("c_custkey"))
    new = op.delete_matched(customers(spark, sf_dir), scored, ["c_custkey"])
    prob = (F.col("c_acctbal") + 1000) / 11000
    return ml.predictions(new, ["c_custkey"], prob, 0.5, 1).drop("scored_at")


@query("score_new_only", NEW_SCORES_SQL)
def score_new_only(spark, sf_dir):
    return new_scores(spark, sf_dir)


@query(
    "prediction_summary",
    f"""
    SELECT count(*) AS n, count(*) FILTER (WHERE frailty_pred = 1) AS n_pos, count(*) FILTER (WHERE frailty_pred = 0)
           AS n_neg, round(avg(frailty_prob), 6) AS mean_prob, min(frailty_prob) AS min_prob, max(frailty_prob) AS
           max_prob FROM ({NEW_SCORES_SQL})
    """,
)
def prediction_summary(spark, sf_dir):
    summary = op.prediction_summary(new_scores(spark, sf_dir), "frailty_prob", "frailty_pred")
    return summary.withColumn("mean_prob", rounded("mean_prob"))


@query("prediction_preview", f"SELECT * FROM ({NEW_SCORES_SQL}) ORDER BY c_custkey LIMIT 20")
def prediction_preview(spark, sf_dir):
    return new_scores(spark, sf_dir).orderBy("c_custkey").limit(20)


@query(
    "retrain_due",
    "SELECT count(quality) AS n_labeled, count(quality) - 300 AS n_new, count(quality) - 300 >= 50 AS is_due FROM labels",
)
def retrain_due(spark, sf_dir):
    return op.retrain_due(table(spark, sf_dir, "labels"), "quality", 300, 50)


@query("logreg_scores")
def logreg_scores(spark, sf_dir):
    """Quality of every document from its length, language and source, fitted on the labelled ones."""
    documents = labeled_documents(spark, sf_dir, "left").drop("toxic")
    features = ["n_chars", "lang", "source"]
    labeled = op.labeled_only(documents, "quality").select(*features, F.col("quality").cast("double").alias("quality"))
    model: PipelineModel = ml.fit_final(labeled, features, "quality", 1.0, "l2")
    scored = model.transform(documents)
    return scored.select("doc_id", F.round(vector_to_array("probability")[1], 4).alias("prob"))


@query(
    "logreg_group_rate",
    """
    WITH r AS (SELECT CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS is_long, quality FROM documents JOIN labels USING (doc_id)
               WHERE quality IS NOT NULL),
    w AS (SELECT *, count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY quality)) AS weight FROM r)
    SELECT is_long, count(*) AS n, round(sum(weight * quality) / sum(weight), 3) AS prob FROM w GROUP BY is_long
    """,
)
def logreg_group_rate(spark, sf_dir):
    """With one feature of 0 and 1 and next to no penalty, the balanced classifier gives the weighted rate of each group."""
    rows = op.labeled_only(labeled_documents(spark, sf_dir), "quality")
    rows = rows.select((F.col("n_chars") >= 1000).cast("int").alias("is_long"), F.col("quality").cast("double").alias("quality"))
    model = ml.fit_final(rows, ["is_long"], "quality", 1e6, "l2")
    scored = model.transform(rows).select("is_long", F.round(vector_to_array("probability")[1], 3).alias("prob"))
    return scored.groupBy("is_long", "prob").agg(F.count(F.lit(1)).alias("n")).select("is_long", "n", "prob")


def order_task() -> ml.ModelTask:
    return ml.ModelTask(
        entity=("o_orderkey",), date="o_orderdate", label="done", hidden=("o_orderkey", "o_orderdate", "done"),
        forbidden=("o_orderstatus",),
    )


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as training rows: is the order done, from its price, priority and customer segment?"""
    segment = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    rows = dated_orders(spark, sf_dir).join(segment, "o_custkey", "left")
    columns = ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority", "c_mktsegment", "c_acctbal"]
    return rows.select(*columns, "done")


def order_store(spark: SparkSession, sf_dir: str) -> Store:
    store = Store(spark, scratch_path(spark, "orders-store"))
    store.gold("training").overwrite(order_rows(spark, sf_dir))
    return store


def searched_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, prevalence and metrics of every grid point on the training and validation split."""
    labeled = op.labeled_only(order_rows(spark, sf_dir), "done")
    features = order_task().features(labeled)
    train_end, val_end = op.cutoff_dates(labeled, "o_orderdate", ml.SPLIT_FRACTIONS)
    splits = labeled.select(*features, "done", op.split_column("o_orderdate", train_end, val_end).alias(ml.SPLIT))
    stages = ml.fit_preparation(splits.filter(F.col(ml.SPLIT) == "train"), features)
    with written(ml.prepared(splits.filter(F.col(ml.SPLIT).isNotNull()), stages, "done", [ml.SPLIT]), "prepared") as frame:
        points = ml.grid_search(frame, "done")
    rows = [
        (p.index, p.strength, p.penalty, split, int(m["n"]), *[float(m[k]) for k in ("prevalence", "auc_pr", "auc_roc", "f1")])
        for p in points
        for split, m in p.metrics.items()
    ]
    schema = "point INT, strength DOUBLE, penalty STRING, split STRING, n LONG, prevalence DOUBLE, auc_pr DOUBLE, auc_roc DOUBLE, f1 DOUBLE"
    return spark.createDataFrame(rows, schema)


@query("grid_search")
def grid_search(spark, sf_dir):
    return searched_grid(spark, sf_dir)


GRID_VALUES = ", ".join(f"({i}, CAST({strength} AS DOUBLE), '{penalty}')" for i, (strength, penalty) in enumerate(ml.GRID))


@query(
    "grid_search_check",
    f"""
    {SPLIT_SQL}
    SELECT CAST(point AS INTEGER) AS point, strength, penalty, split, count(*) AS n, round(avg(done), 6) AS prevalence, TRUE AS is_sound
    FROM t, (VALUES {GRID_VALUES}) g(point, strength, penalty) WHERE split <> 'test' GROUP BY ALL
    """,
)
def grid_search_check(spark, sf_dir):
    """Every grid point is judged on the whole splits, and its metrics lie where they must.

    The cut with the best F1 is at least as good as calling everything positive.
    """
    all_positive = 2 * F.col("prevalence") / (1 + F.col("prevalence"))
    within = F.col("auc_pr").between(0, 1) & F.col("auc_roc").between(0, 1)
    sound = within & ((F.col("split") != "val") | (F.col("f1") >= all_positive - 1e-6))
    rows = searched_grid(spark, sf_dir).withColumn("is_sound", sound)
    return rows.select("point", "strength", "penalty", "split", "n", rounded("prevalence").alias("prevalence"), "is_sound")


@query("champion_scoring")
def champion_scoring(spark, sf_dir):
    """Train, promote, and score all assembled orders with the champion."""
    return scored_orders(spark, sf_dir).gold("predictions").read().drop("scored_at")


def scored_orders(spark: SparkSession, sf_dir: str) -> Store:
    store = order_store(spark, sf_dir)
    ml.train(store, order_task(), grid=((0.1, "l2"),), gates=(0.0, 0.0))
    store.gold("assembled").overwrite(store.gold("training").read().drop("done"))
    ml.score_new(store, order_task())
    return store


@query(
    "champion_scoring_check",
    """
    SELECT count(*) AS n, count(DISTINCT o_orderkey) AS n_entities, CAST(0 AS BIGINT) AS n_out_of_range, CAST(0 AS BIGINT) AS n_misjudged,
           CAST(1 AS BIGINT) AS n_versions, CAST(0 AS BIGINT) AS n_scored_again, TRUE AS ranks_better_than_chance FROM orders
    """,
)
def champion_scoring_check(spark, sf_dir):
    """What must hold of scored orders: each once, by one version, the class by the threshold, and none a second time."""
    store = scored_orders(spark, sf_dir)
    again, _ = ml.score_new(store, order_task())
    rows = store.gold("predictions").read()
    prob, pred, cut = F.col("frailty_prob"), F.col("frailty_pred"), F.col("threshold")
    # The class is decided before the probability is rounded to four digits.
    misjudged = (pred != (prob >= cut).cast("int")) & (F.abs(prob - cut) > 5e-5)
    done = store.gold("training").read().select("o_orderkey", "done")
    auc = op.roc_auc(rows.join(done, "o_orderkey"), "frailty_prob", "done").select("auc_roc").scalar()
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("n_entities"),
        F.count_if(~prob.between(0, 1)).alias("n_out_of_range"), F.count_if(misjudged).alias("n_misjudged"),
        F.count_distinct("champion_version").alias("n_versions"),
        F.lit(0 if again == "SKIPPED" else 1).cast("long").alias("n_scored_again"),
    ).withColumn("ranks_better_than_chance", auc > 0.5)
