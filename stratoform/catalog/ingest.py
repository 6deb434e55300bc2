"""Reading, typing, loading and generating tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.catalog.registry import SINCE, query
from stratoform.catalog.sql import hash1, with_tables
from stratoform.functions.amounts import money
from stratoform.functions.dates import instant
from stratoform.functions.hashing import Hash
from stratoform.model import views
from stratoform.session import scratch_path
from stratoform.sources.changes import WINDOW, KeyedTable, changed_since, newest
from stratoform.sources.files import (
    FrameSource,
    ParquetSource,
    TypedLoad,
    count_tables,
    read_csv,
    read_text_columns,
    type_text_columns,
    write_csv,
)
from stratoform.sources.generate import sales as generated_sales
from stratoform.sources.load import TableLoad, load_all
from stratoform.sources.partitioned import YearlyTable
from stratoform.streaming.changes import upsert_new_files

CUTOFF = dt.datetime(2024, 1, 20)
ALL_TABLES = (*views.TABLES, "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query("csv_roundtrip", "SELECT * FROM events")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties hold quotes and commas, so quoting is put to the test."""
    events = views.table(spark, sf_dir, "events")
    path = scratch_path(spark, "events-csv")
    write_csv(events, path)
    return read_csv(spark, path, events.schema)


_STAGED = """
    SELECT CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS ord_id,
           nullif(CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority END, '') AS priority,
           CASE WHEN o_orderkey % 13 = 0 THEN 'unknown'
                ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
           strftime(o_orderdate, '%Y-%m-%d') AS placed
    FROM orders"""


def staged_orders(spark: SparkSession, sf_dir: str) -> TypedLoad:
    """Orders as delivered text: blanks for missing values, words where numbers belong."""
    key = F.col("o_orderkey")
    delivered = views.table(spark, sf_dir, "orders").select(
        F.when(key % 97 == 0, "").otherwise(F.concat(F.lit(" "), key.cast("string"))).alias("ord_id"),
        F.when(key % 7 == 0, " ").otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(key % 13 == 0, "unknown").otherwise(money(F.col("o_totalprice")).cast("string")).alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("placed"),
    )
    path = scratch_path(spark, "orders-text")
    write_csv(delivered, path)
    staged = read_text_columns(spark, path, delivered.columns)
    types = {"ord_id": "bigint", "priority": "string", "amount": "decimal(12,2)", "placed": "date"}
    return type_text_columns(staged, types, required=["ord_id"])


@query(
    "staged_typed_load",
    f"""SELECT CAST(ord_id AS BIGINT) AS ord_id, priority, CAST(amount AS DOUBLE) AS amount,
               CAST(placed AS DATE) AS placed
        FROM ({_STAGED}) WHERE ord_id IS NOT NULL AND amount <> 'unknown'""",
)
def staged_typed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_orders(spark, sf_dir).accepted


@query(
    "staged_rejects",
    f"""SELECT ord_id, amount, CASE WHEN amount = 'unknown' THEN 'amount' ELSE '' END AS unparsed,
               CASE WHEN ord_id IS NULL THEN 'ord_id' ELSE '' END AS missing
        FROM ({_STAGED}) WHERE ord_id IS NULL OR amount = 'unknown'""",
)
def staged_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = staged_orders(spark, sf_dir).rejected
    return rejected.select(F.trim("ord_id").alias("ord_id"), "amount", "unparsed", "missing")


_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS records FROM {t}" for t in ALL_TABLES)


@query(
    "table_counts",
    f"""WITH c AS ({_COUNTS})
        SELECT * FROM c UNION ALL SELECT 'TOTAL', CAST(sum(records) AS BIGINT) FROM c""",
)
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tables({t: views.table(spark, sf_dir, t) for t in ALL_TABLES})


@query(
    "incremental_extract",
    "SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY",
)
def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    return changed_since(events, "ts", newest(events, "ts") - WINDOW)


@query(
    "upsert_latest",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER
              (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load up to a day, then the changes since a day earlier merged in twice."""
    events = views.table(spark, sf_dir, "events")
    target = KeyedTable(scratch_path(spark, "latest-event"), ("user_id",), ("ts", "event_id"))
    target.replace(events.where(F.col("ts") <= instant(CUTOFF, events.schema["ts"].dataType)))
    changes = changed_since(events, "ts", CUTOFF - WINDOW)
    target.upsert(changes)
    target.upsert(changes)
    return target.read(spark).select(*events.columns)


@query(
    "stream_upsert_latest",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER
              (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def stream_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = views.table(spark, sf_dir, "events").schema
    target = KeyedTable(scratch_path(spark, "stream-event"), ("user_id",), ("ts", "event_id"))
    state = scratch_path(spark, "stream-state")
    upsert_new_files(spark, sf_dir, schema, target, state, pattern="events.parquet")
    return target.read(spark).select(*schema.names)


@query(
    "load_summary",
    """SELECT 1 AS run, 'customer' AS table_name, 'full' AS load_mode, 'success' AS status,
              (SELECT count(*) FROM customer) AS records
       UNION ALL SELECT 1, 'events', 'full', 'success', (SELECT count(*) FROM events WHERE ts <= TIMESTAMP '2024-01-20')
       UNION ALL SELECT 1, 'orders', 'full', 'success', (SELECT count(*) FROM orders)
       UNION ALL SELECT 1, 'absent', 'full', 'failed', 0
       UNION ALL SELECT 2, 'customer', 'full', 'success', (SELECT count(*) FROM customer)
       UNION ALL SELECT 2, 'events', 'increment', 'success',
              (SELECT count(*) FROM events
               WHERE ts >= date_trunc('day', (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '2024-01-20')) - INTERVAL 1 DAY)
       UNION ALL SELECT 2, 'orders', 'increment', 'success',
              (SELECT count(*) FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 1 DAY)
       UNION ALL SELECT 2, 'absent', 'full', 'failed', 0""",
)
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of a load of four tables, one of which does not exist."""
    root = scratch_path(spark, "bronze")
    events = views.table(spark, sf_dir, "events")
    known = events.where(F.col("ts") <= instant(CUTOFF, events.schema["ts"].dataType))

    def load(name: str, source: object, key: str, change_time: str | None) -> TableLoad:
        order = (change_time or key,)
        return TableLoad(name, source, KeyedTable(f"{root}/{name}", (key,), order), change_time)

    def loads(event_rows: DataFrame) -> list[TableLoad]:
        return [
            load("customer", ParquetSource(f"{sf_dir}/customer.parquet"), "c_custkey", None),
            load("events", FrameSource(event_rows), "event_id", "ts"),
            load("orders", ParquetSource(f"{sf_dir}/orders.parquet"), "o_orderkey", "o_orderdate"),
            load("absent", ParquetSource(f"{sf_dir}/absent.parquet"), "id", None),
        ]

    runs = [load_all(spark, loads(rows)) for rows in (known, events)]
    shown = [
        r.select(F.lit(i).alias("run"), "table_name", "load_mode", "status", "records")
        for i, r in enumerate(runs, start=1)
    ]
    return shown[0].unionByName(shown[1])


_REST = """
    SELECT event_id, CASE event_id % 50 WHEN 1 THEN w WHEN 2 THEN w - INTERVAL 12 HOUR WHEN 3 THEN NULL ELSE ts END AS ts,
           * EXCLUDE (event_id, ts, w)
    FROM events, (SELECT max(ts) AS w FROM events WHERE ts <= TIMESTAMP '2024-01-20')
    WHERE ts > TIMESTAMP '2024-01-20'"""


@query(
    "load_late_rows",
    f"""SELECT keyed, t.* FROM (SELECT unnest([true, false]) AS keyed),
               (SELECT event_id, ts, * EXCLUDE (event_id, ts) FROM events WHERE ts <= TIMESTAMP '2024-01-20'
                UNION ALL {_REST}) t""",
)
def load_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after a load, a load with late, equal-time and undated rows, and a repeated one; with and without keys."""
    root = scratch_path(spark, "late")
    events = views.table(spark, sf_dir, "events")
    kind = events.schema["ts"].dataType
    known = events.where(F.col("ts") <= instant(CUTOFF, kind))
    mark = newest(known, "ts")
    turn = F.col("event_id") % 50
    moved = (
        F.when(turn == 1, instant(mark, kind))
        .when(turn == 2, instant(mark - dt.timedelta(hours=12), kind))
        .when(turn == 3, F.lit(None).cast(kind))
        .otherwise(F.col("ts"))
    )
    later = known.unionByName(events.where(F.col("ts") > instant(CUTOFF, kind)).withColumn("ts", moved))
    targets = {True: KeyedTable(f"{root}/keyed", ("event_id",), ("ts",)), False: KeyedTable(f"{root}/plain", (), ("ts",))}
    for rows in (known, later, later):
        load_all(spark, [TableLoad(f"events-{k}", FrameSource(rows), t, "ts") for k, t in targets.items()])
    shown = [t.read(spark).select(F.lit(k).alias("keyed"), *events.columns) for k, t in targets.items()]
    return shown[0].unionByName(shown[1])


YEARS = (1996, 2000)


@query(
    "partitioned_fact_scan",
    with_tables(
        """SELECT CAST(extract(year FROM sale_date) AS INTEGER) AS sale_year, count(*) AS total_sales,
                  CAST(sum(net_amount) AS DOUBLE) AS total_revenue
           FROM recent WHERE sale_date < DATE '2001-01-01' GROUP BY 1""",
        "recent",
    ),
)
def partitioned_fact_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = YearlyTable(scratch_path(spark, "fact-by-year"), "sale_date", *YEARS)
    fact.write(views.sales(spark, sf_dir))
    return (
        fact.read(spark, since=SINCE)
        .groupBy("sale_year")
        .agg(F.count(F.lit(1)).alias("total_sales"), F.sum("net_amount").alias("total_revenue"))
    )


@query(
    "partitioned_fact_rejects",
    with_tables(
        """SELECT CAST(extract(year FROM sale_date) AS INTEGER) AS sale_year, count(*) AS total_sales FROM sales
           WHERE extract(year FROM sale_date) NOT BETWEEN 1996 AND 2000 GROUP BY 1""",
        "sales",
    ),
)
def partitioned_fact_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = YearlyTable("", "sale_date", *YEARS).rejected(views.sales(spark, sf_dir))
    return rejected.groupBy(F.year("sale_date").alias("sale_year")).agg(F.count(F.lit(1)).alias("total_sales"))


def _draw(what: str, choices: str) -> str:
    text = f"o_orderkey || ':{what}'"
    return f"{hash1(text)} % {choices}"


def _key(prefix: str, number: str, width: int) -> str:
    return f"'{prefix}' || lpad(CAST({number} AS VARCHAR), CAST(greatest({width}, length(CAST({number} AS VARCHAR))) AS INTEGER), '0')"


@query(
    "gen_sales",
    f"""WITH n AS (SELECT (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM part) AS products,
                          (SELECT count(*) FROM supplier) AS locations),
             d AS (SELECT o_orderkey, {_draw("customer", "customers")} + 1 AS customer,
                          {_draw("product", "products")} + 1 AS product, {_draw("location", "locations")} + 1 AS location,
                          {_draw("day", "365")} AS day, CAST({_draw("quantity", "5")} + 1 AS INTEGER) AS quantity,
                          {_draw("price", "148001")} + 2000 AS cents, {_draw("discount", "21")} AS percent
                   FROM orders, n)
        SELECT {_key("SALE", "o_orderkey", 6)} AS sale_id, {_key("CUST", "customer", 3)} AS customer_id,
               {_key("PROD", "product", 3)} AS product_id, {_key("LOC", "location", 3)} AS location_id,
               DATE '2024-01-01' + CAST(day AS INTEGER) AS sale_date, quantity, cents / 100.0 AS unit_price,
               quantity * cents / 100.0 AS total_amount,
               (quantity * cents * percent + 50) // 100 / 100.0 AS discount_amount,
               (quantity * cents - (quantity * cents * percent + 50) // 100) / 100.0 AS net_amount
        FROM d""",
)
def gen_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generated sale for each order number, on members of the real dimensions."""
    sizes = [views.table(spark, sf_dir, t).count() for t in ("customer", "part", "supplier")]
    orders = views.table(spark, sf_dir, "orders")
    return generated_sales(orders, "o_orderkey", *sizes, kind=Hash.PORTABLE).drop("created_at")
