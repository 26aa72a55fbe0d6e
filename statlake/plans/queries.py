"""Queries over the benchmark tables, each with the SQL that gives the same rows.

Change feeds, catalogues and geometry are derived by Spark from whole tables, so the work
grows with them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.lookups import blank_to_null, truncated
from ..model import ChangeColumns, Layout, TableMeta
from ..operators import catalog as cat
from ..operators import cdc, digesttree, geo, history, hotkeys, limits, quality, reshape, search, textindex
from ..operators.filters import (
    current_state, date_range, dimension_contains, from_source, without_geometry,
)
from ..operators.ranking import with_row_index
from ..sources import readers, writers
from ..streaming.stream import read_feed_stream, stream_changelog
from ..streaming.sync import sync, sync_changelog, sync_log, sync_snapshot
from ..streaming.versions import VersionedTable
from .lake import Lake
from .lineage import cut_lineage, scratch_path
from .sizing import measured_bytes, tasks_for

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        _ORACLES[fn.__name__] = sql
        return fn
    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return readers.read_table(spark, f"{sf}/{name}.parquet")


# --------------------------------------------------------------------------- reads

@query("""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 100
""")
def orders_recent_100(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return limits.most_recent(orders, 100, date="o_orderdate", tie_break=["o_orderkey"])


@query("""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS o_orderdate
           FROM orders)
SELECT * FROM (SELECT * FROM o WHERE o_orderdate IS NULL ORDER BY o_orderkey DESC LIMIT 500)
UNION ALL
SELECT * FROM (SELECT * FROM o WHERE o_orderdate IS NOT NULL ORDER BY o_orderdate DESC, o_orderkey DESC
      LIMIT greatest(0, 500 - (SELECT count(*) FROM o WHERE o_orderdate IS NULL)))
""")
def orders_recent_undated(spark, sf):
    """Undated rows count as the most recent."""
    dated = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate"))
    orders = table(spark, sf, "orders").select("o_orderkey", dated.alias("o_orderdate"))
    return limits.most_recent(orders, 500, date="o_orderdate", tie_break=["o_orderkey"])


_LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


@query(f"""
SELECT *, CAST(l_shipdate AS DATE) AS day FROM lineitem
ORDER BY day DESC, {", ".join(c + " DESC" for c in _LINE_ORDER)} LIMIT 1000
""")
def lineitem_recent_two_pass(spark, sf):
    """All columns of the latest rows; the cut-off date is found from the date alone."""
    lines = table(spark, sf, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    return limits.most_recent(lines, 1000, date="day", tie_break=_LINE_ORDER, two_pass=True)


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey")
def orders_by_date(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return limits.sort_by_date(orders, "o_orderdate", ["o_orderkey"])


@query("SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 50")
def part_first_50(spark, sf):
    """No date column: the first rows by the given order."""
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return limits.most_recent(part, 50, tie_break=["p_partkey"])


@query("""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1997-12-31'
""")
def orders_date_range(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return date_range(orders, "1997-01-01", "1997-12-31", column="o_orderdate")


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
WHERE o_orderdate <= TIMESTAMP '1996-06-30'
""")
def orders_text_dates(spark, sf):
    """Dates kept as text are parsed, then bounded."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    orders = readers.parse_date(table(spark, sf, "orders").select("o_orderkey", day.alias("date")))
    return date_range(orders, end="1996-06-30").select(
        "o_orderkey", F.date_format("date", "yyyy-MM-dd").alias("day"))


@query("""
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10 06:00:00'
""")
def events_declared_date_axis(spark, sf):
    """The date column is the one the table's metadata names."""
    meta = TableMeta.of({"name": "events", "date_filter_column": "ts"})
    return date_range(table(spark, sf, "events").select("event_id", "ts"),
                      start="2024-01-10T06:00:00", meta=meta)


@query("SELECT p_partkey, p_name, p_size FROM part")
def date_bounds_ignored(spark, sf):
    """A table without a date axis is returned whole."""
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    return date_range(part, "1997-01-01", "1997-12-31",
                      meta=TableMeta.of({"name": "part", "date_filter_column": None}))


@query("""
SELECT p_partkey, p_name, p_brand, p_type FROM part
WHERE contains(lower(p_name), 'pro') OR contains(lower(p_brand), 'pro') OR contains(lower(p_type), 'pro')
   OR contains(lower(p_name), 'pro')
""")
def part_dimension_contains(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return dimension_contains(part, "Pro")


@query("""
SELECT doc_id FROM documents
WHERE contains(lower(text), 'src1') OR contains(lower(lang), 'src1') OR contains(lower(source), 'src1')
   OR contains(lower(text), 'src1')
""")
def documents_dimension_contains(spark, sf):
    return dimension_contains(table(spark, sf, "documents"), "SRC1").select("doc_id")


@query("SELECT doc_id, lang, source FROM documents WHERE source = 'src7'")
def documents_from_source(spark, sf):
    return from_source(table(spark, sf, "documents").select("doc_id", "lang", "source"), "src7")


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'TRUE' WHEN 'P' THEN 'true' ELSE 'false' END AS is_current
FROM orders WHERE o_orderstatus IN ('O', 'P')
""")
def current_state_bool_text(spark, sf):
    return current_state(_flagged(table(spark, sf, "orders")).select("o_orderkey", "is_current"),
                         "is_current = true")


def _flagged(orders: DataFrame) -> DataFrame:
    status = F.col("o_orderstatus")
    return orders.withColumn("is_current", F.when(status == "O", "TRUE").when(status == "P", "true")
                             .otherwise("false"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_linenumber = 3")
def current_state_number(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return current_state(lines, "l_linenumber = 3")


@query("SELECT page_id, url FROM pages")
def pages_without_html(spark, sf):
    """The heavy column plays geometry; it is pruned from the scan."""
    return without_geometry(table(spark, sf, "pages").withColumnRenamed("html", "geometry_wkt"))


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND contains(lower(o_orderpriority), 'urgent')
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 200
""")
def lake_get(spark, sf):
    """The whole filtered read: date range, dimension, most recent, one lazy plan."""
    return _orders_lake(spark, sf).get("orders", start="1996-01-01", dimensions="urgent", limit=200,
                                       tie_break=["o_orderkey"])


def _orders_lake(spark, sf) -> Lake:
    """A lake of one dataset, its catalogue written as JSON and read back."""
    listing = (table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("row_count_at_last_refresh"))
               .select(F.array(F.struct(
                   F.lit("orders").alias("name"), F.lit(f"{sf}/orders.parquet").alias("path"),
                   F.lit("o_orderdate").alias("date_filter_column"), F.lit("long").alias("layout"),
                   F.array(F.lit("o_orderkey"), F.lit("o_orderpriority")).alias("id_columns"),
                   F.array(F.lit("o_totalprice")).alias("value_columns"), F.lit("o_orderstatus").alias("measure_name_column"),
                   "row_count_at_last_refresh")).alias("datasets")))
    path = scratch_path(spark, "catalogue")
    listing.coalesce(1).write.json(path)
    return Lake(spark, readers.read_catalog(spark, path))


@query("SELECT 'orders' AS name, 'o_orderdate' AS date_filter_column, count(*) AS row_count_at_last_refresh FROM orders")
def catalog_from_json(spark, sf):
    """A JSON catalogue, read and listed."""
    return _orders_lake(spark, sf).list().select("name", "date_filter_column", "row_count_at_last_refresh")


@query("SELECT least(10, count(*)) AS n_rows, 6 AS n_columns FROM orders")
def lake_preview(spark, sf):
    """A preview: which rows it holds is not fixed, how many are."""
    few = _orders_lake(spark, sf).preview("orders", 50)
    return few.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(few.columns)).alias("n_columns"))


@query("""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 300
""")
def lake_download(spark, sf):
    """A live export of the most recent rows since a date, as CSV."""
    lake, path = _orders_lake(spark, sf), scratch_path(spark, "export")
    lake.download("orders", path, "csv", start="1997-01-01", limit=300, tie_break=["o_orderkey"])
    return readers.read_table(spark, path, "csv", schema=table(spark, sf, "orders").schema).select("o_orderkey", "o_totalprice")


@query("SELECT * FROM orders")
def lake_download_bulk(spark, sf):
    """The whole table as its synced copy has it, exported in another format."""
    lake, root = _orders_lake(spark, sf), scratch_path(spark, "copy")
    lake.sync("orders", root)
    path = lake.download_bulk("orders", scratch_path(spark, "bulk"), "json", root=root)
    return readers.read_table(spark, path, "json", schema=table(spark, sf, "orders").schema)


@query("""
SELECT o_orderkey, o_orderpriority, max(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS F,
       max(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS O, max(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS P
FROM orders GROUP BY 1, 2
""")
def lake_to_wide(spark, sf):
    """Reshaped by the layout that the catalogue declares."""
    lake = _orders_lake(spark, sf)
    wide, layout = lake.to_wide("orders", id_columns=["o_orderkey", "o_orderpriority"])
    return wide.select(*layout.id_columns, *layout.value_columns)


@query("SELECT 500 AS limit_rows, count(*) > 500 AS truncated, count(*) AS total, least(500, count(*)) AS n_records FROM lineitem")
def export_capped(spark, sf):
    """A small answer: at most 500 records, and whether there are more."""
    found = limits.capped(table(spark, sf, "lineitem"), 9999, count=True)
    return table(spark, sf, "lineitem").limit(1).select(
        F.lit(found.limit).alias("limit_rows"), F.lit(found.truncated).alias("truncated"),
        F.lit(found.total).cast("long").alias("total"), F.lit(len(found.records)).cast("long").alias("n_records"))


@query(f"SELECT * FROM lineitem ORDER BY l_shipdate DESC, {', '.join(c + ' DESC' for c in _LINE_ORDER)} LIMIT 20000")
def lineitem_recent_many(spark, sf):
    """More rows than one task should merge, found by ranking."""
    return limits.most_recent(table(spark, sf, "lineitem"), 20_000, date="l_shipdate", tie_break=_LINE_ORDER, two_pass=True)


@query("""
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'statsnz' ELSE 'Stats NZ' END AS source FROM documents WHERE doc_id % 2 = 1
""")
def catalog_of_publisher(spark, sf):
    """A short publisher name stands for its label, and only for that."""
    label = F.when(F.col("doc_id") % 2 == 0, "statsnz").otherwise("Stats NZ")
    return Lake(spark, table(spark, sf, "documents").select("doc_id", label.alias("source"))).list(publisher="statsnz")


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'statsnz' ELSE 'Stats NZ' END AS source FROM documents WHERE doc_id % 2 = 0")
def catalog_of_exact_source(spark, sf):
    """A source that reads like a short publisher name is matched as it is."""
    label = F.when(F.col("doc_id") % 2 == 0, "statsnz").otherwise("Stats NZ")
    return Lake(spark, table(spark, sf, "documents").select("doc_id", label.alias("source"))).list("statsnz")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y') || 'Q1'
                        ELSE strftime(o_orderdate, '%Y-%m-%d') END AS time_frame
FROM orders WHERE o_orderstatus = 'P' OR o_orderdate >= TIMESTAMP '1997-06-30'
""")
def orders_unreadable_dates(spark, sf):
    """Text that is no date is kept where the caller says so; by default it is an error."""
    frame = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy'Q1'")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    orders = table(spark, sf, "orders").select("o_orderkey", frame.alias("time_frame"))
    return date_range(orders, "1997-06-30", column="time_frame", unreadable="keep")


# --------------------------------------------------------------------------- changes

def orders_feed(spark: SparkSession, sf: str, names: ChangeColumns = cdc.NAMES) -> DataFrame:
    """A feed for ``orders``, one pass: what happens to an order follows from its priority.

    Urgent: delete and insert at a higher price.  High: update.  Medium: delete.
    Low: a new order under a negative key.  Not specified: nothing.
    """
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    priority = F.col("o_orderpriority")

    def step(n, op, new_key, new_price):
        return F.struct(F.lit(n).alias("n"), F.lit(op).alias("op"), new_key.alias("k"),
                        new_price.alias("p"))

    steps = (F.when(priority == "1-URGENT", F.array(step(0, "D", key, price), step(1, "I", key, price + 1)))
             .when(priority == "2-HIGH", F.array(step(0, "U", key, price + 2)))
             .when(priority == "3-MEDIUM", F.array(step(0, "D", key, price)))
             .when(priority == "5-LOW", F.array(step(0, "I", -key - 1, price))))
    return table(spark, sf, "orders").select("*", F.explode(steps).alias("s")).select(
        (key * 2 + F.col("s.n") + 1).alias(names.seq), F.col("s.op").alias(names.op),
        F.lit("2024-01-01T00:00:00Z").alias(names.committed_at),
        F.lit("s1").alias(names.snapshot_id),
        F.col("s.k").alias("o_orderkey"), "o_custkey", "o_orderstatus",
        F.col("s.p").alias("o_totalprice"), "o_orderdate", "o_orderpriority")


_FEED_SQL = """
WITH steps AS (SELECT o.*, unnest(CASE o_orderpriority
    WHEN '1-URGENT' THEN [{'n': 0, 'op': 'D', 'k': o_orderkey, 'p': o_totalprice}, {'n': 1, 'op': 'I', 'k': o_orderkey, 'p': o_totalprice + 1}]
    WHEN '2-HIGH' THEN [{'n': 0, 'op': 'U', 'k': o_orderkey, 'p': o_totalprice + 2}]
    WHEN '3-MEDIUM' THEN [{'n': 0, 'op': 'D', 'k': o_orderkey, 'p': o_totalprice}]
    WHEN '5-LOW' THEN [{'n': 0, 'op': 'I', 'k': -o_orderkey - 1, 'p': o_totalprice}] END) AS s FROM orders o),
feed AS (SELECT o_orderkey * 2 + s.n + 1 AS seq, s.op AS op, s.k AS k, s.p AS p FROM steps),
by_status AS (SELECT o_orderstatus AS k, seq, op, p FROM feed JOIN orders ON feed.k = orders.o_orderkey)
"""


@query(_FEED_SQL + """
, asked AS (SELECT o_orderkey AS k, o_orderkey * 2 + d AS "at" FROM orders, (VALUES (0), (1), (2), (1000)) x(d))
SELECT k AS o_orderkey, "at", CASE WHEN op <> 'D' THEN seq END AS _seq, CASE WHEN op <> 'D' THEN p END AS o_totalprice
FROM asked LEFT JOIN (SELECT a.k, a."at", arg_max(op, seq) AS op, max(seq) AS seq, arg_max(p, seq) AS p
                      FROM asked a JOIN feed f ON f.k = a.k AND f.seq <= a."at" GROUP BY ALL) USING (k, "at")
""")
def feed_rows_at(spark, sf):
    """Every order at four points of the feed: before its first change, between its changes, after them, and later."""
    feed = orders_feed(spark, sf).select(*cdc.NAMES.all, "o_orderkey", "o_totalprice")
    asked = table(spark, sf, "orders").select("o_orderkey", F.explode(F.array(*[
        (F.col("o_orderkey") * 2 + d).cast("long") for d in (0, 1, 2, 1000)])).alias("at"))
    return history.rows_at(feed, asked, ["o_orderkey"], block=4096)


@query(_FEED_SQL + """
, asked AS (SELECT o_orderstatus AS k, o_orderkey * 2 AS "at" FROM orders)
SELECT k AS o_orderstatus, "at", CASE WHEN op <> 'D' THEN seq END AS _seq, CASE WHEN op <> 'D' THEN p END AS o_totalprice
FROM asked ASOF LEFT JOIN by_status ON asked.k = by_status.k AND asked."at" >= by_status.seq
""".replace("SELECT k AS", "SELECT asked.k AS"))
def feed_rows_at_hot(spark, sf):
    """Three keys share the whole feed; each is asked about once per order."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    feed = orders_feed(spark, sf).select(*cdc.NAMES.all, "o_orderkey", "o_totalprice").join(orders, "o_orderkey")
    asked = orders.select("o_orderstatus", (F.col("o_orderkey") * 2).cast("long").alias("at"))
    return history.rows_at(feed.drop("o_orderkey"), asked, ["o_orderstatus"], block=4096)


_ORDERS_MERGED = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus,
       o_totalprice + CASE o_orderpriority WHEN '1-URGENT' THEN 1 ELSE 2 END, o_orderdate, o_orderpriority
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
UNION ALL
SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderpriority = '5-LOW'
"""


@query(_ORDERS_MERGED)
def cdc_merge_orders(spark, sf):
    return cdc.merge_changes(table(spark, sf, "orders"), orders_feed(spark, sf), ["o_orderkey"])


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_suppkey, 0) AS l_suppkey, l_quantity,
                  l_returnflag FROM lineitem),
touched AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM l WHERE l_returnflag <> 'N')
SELECT l.* FROM l WHERE NOT EXISTS (SELECT 1 FROM touched t
  WHERE t.l_orderkey = l.l_orderkey AND t.l_linenumber = l.l_linenumber AND t.l_partkey = l.l_partkey
    AND t.l_suppkey IS NOT DISTINCT FROM l.l_suppkey)
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity + 1, l_returnflag FROM l
WHERE l_returnflag = 'A'
""")
def cdc_merge_composite(spark, sf):
    """Four key columns, one of them sometimes null."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.nullif("l_suppkey", F.lit(0)).alias("l_suppkey"),
        "l_quantity", "l_returnflag")
    flag = F.col("l_returnflag")
    ops = F.when(flag == "A", F.array(F.lit("D"), F.lit("I"))).when(flag == "R", F.array(F.lit("D")))
    feed = (lines.withColumn("at", F.monotonically_increasing_id())
            .select("*", F.posexplode(ops).alias("n", "_op"))
            .withColumn("l_quantity", F.when(F.col("_op") == "I", F.col("l_quantity") + 1)
                        .otherwise(F.col("l_quantity")))
            .withColumn("_seq", F.col("at") * 2 + F.col("n") + 1).drop("at", "n"))
    return cdc.merge_changes(lines, feed, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


_SCD2_MERGED = """
SELECT o_orderkey, o_totalprice, CASE o_orderstatus WHEN 'O' THEN 'TRUE' ELSE 'true' END AS is_current
FROM orders WHERE o_orderstatus IN ('O', 'P') AND o_orderpriority <> '1-URGENT'
UNION ALL
SELECT o_orderkey, o_totalprice + 1, 'True' FROM orders WHERE o_orderpriority = '1-URGENT'
"""


def _versioned_orders(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Orders with history rows among them, and a feed of new versions of urgent orders:
    delete, the old version as history, the new version as current."""
    state = _flagged(table(spark, sf, "orders")).select("o_orderkey", "o_totalprice", "is_current",
                                                        "o_orderpriority")
    steps = F.array(*[F.struct(F.lit(op).alias("_op"), F.lit(flag).alias("flag"), F.lit(add).alias("add"))
                      for op, flag, add in (("D", "True", 0), ("I", "False", 0), ("I", "True", 1))])
    feed = (state.filter(F.col("o_orderpriority") == "1-URGENT")
            .select("*", F.posexplode(steps).alias("n", "s"))
            .select((F.col("o_orderkey") * 3 + F.col("n") + 1).alias("_seq"), F.col("s._op").alias("_op"),
                    "o_orderkey", (F.col("o_totalprice") + F.col("s.add")).alias("o_totalprice"),
                    F.col("s.flag").alias("is_current")))
    return state.drop("o_orderpriority"), feed


@query(_SCD2_MERGED)
def cdc_merge_scd2(spark, sf):
    """Only live rows stay after a merge."""
    return cdc.merge_changes(*_versioned_orders(spark, sf), ["o_orderkey"],
                             state_filter="is_current = true")


def events_feed(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as a feed for ``customer``: many changes per key, in event order."""
    kind = F.col("event_type")
    op = F.when(kind == "error", "D").when(kind == "signup", "I").otherwise("U")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("_seq"), op.alias("_op"), F.col("user_id").alias("c_custkey"),
        kind.alias("c_name"), F.col("value").alias("c_acctbal"))


@query("""
WITH last AS (SELECT * FROM events
              QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)
UNION ALL
SELECT user_id, event_type, value FROM last WHERE event_type <> 'error'
""")
def cdc_merge_latest(spark, sf):
    state = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return cdc.merge_changes(state, events_feed(spark, sf), ["c_custkey"], keep="latest")


@query("""
SELECT user_id AS c_custkey, event_id AS _seq,
       CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'I' ELSE 'U' END AS _op,
       event_type AS c_name, value AS c_acctbal
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
""")
def cdc_latest_per_key(spark, sf):
    return cdc.latest_per_key(events_feed(spark, sf), ["c_custkey"])


def _edited_orders(spark, sf) -> DataFrame:
    """Orders after the feed's changes, computed directly."""
    key, price, priority = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderpriority")
    orders = table(spark, sf, "orders")
    kept = orders.filter(priority != "3-MEDIUM").withColumn(
        "o_totalprice", F.when(priority == "1-URGENT", price + 1).when(priority == "2-HIGH", price + 2)
        .otherwise(price))
    return kept.unionByName(orders.filter(priority == "5-LOW").withColumn("o_orderkey", -key - 1))


_DIFF = f"""
WITH edited AS ({_ORDERS_MERGED}),
d AS (SELECT 'D' AS _op, x.* FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM edited) x
      UNION ALL
      SELECT 'I' AS _op, x.* FROM (SELECT * FROM edited EXCEPT ALL SELECT * FROM orders) x)
"""


@query(_DIFF + "SELECT * FROM d")
def cdc_diff(spark, sf):
    return cdc.diff_rows(table(spark, sf, "orders"), _edited_orders(spark, sf))


@query(_DIFF + "SELECT * FROM d")
def cdc_diff_tree(spark, sf):
    """Both tables stored with trees of digests; only hash ranges that differ are read again."""
    old, new = (scratch_path(spark, f"digested-{n}") for n in ("old", "new"))
    digesttree.write_digested(table(spark, sf, "orders"), old, ["o_orderkey"])
    digesttree.write_digested(_edited_orders(spark, sf), new, ["o_orderkey"])
    return digesttree.diff_stored(spark, old, new)


_MOVING = """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS a,
                  CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS b FROM orders),
n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN b ELSE a END AS a, CASE WHEN o_orderkey % 6 = 0 THEN a ELSE b END AS b FROM o)
"""


@query(_MOVING + """
SELECT 'D' AS _op, o.* FROM o WHERE o_orderkey % 6 = 0 UNION ALL SELECT 'I', n.* FROM n WHERE o_orderkey % 6 = 0
""")
def cdc_diff_by_digest(spark, sf):
    """Changes found by shuffling digests, where all that changes is which of two columns is null."""
    key, third, sixth = F.col("o_orderkey"), F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") % 6 == 0
    old = table(spark, sf, "orders").select(key, F.when(~third, F.col("o_orderstatus")).alias("a"),
                                            F.when(third, F.col("o_orderstatus")).alias("b"))
    new = old.select(key, F.when(sixth, F.col("b")).otherwise(F.col("a")).alias("a"),
                     F.when(sixth, F.col("a")).otherwise(F.col("b")).alias("b"))
    return cdc.diff_rows(old, new, by_digest=True)


@query(_DIFF + """
SELECT 100 + row_number() OVER (ORDER BY _op, o_orderkey) AS _seq, _op, '2024-01-02' AS _committed_at,
       's2' AS _snapshot_id, o_orderkey, o_totalprice FROM d
""")
def cdc_diff_feed(spark, sf):
    """The diff as a feed: dense sequence numbers, deletes first."""
    return cdc.diff_snapshots(
        table(spark, sf, "orders"), _edited_orders(spark, sf), ["o_orderkey"],
        after_seq=100, committed_at="2024-01-02", snapshot_id="s2",
    ).select("_seq", "_op", "_committed_at", "_snapshot_id", "o_orderkey", "o_totalprice")


def _comparison(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row: rows of the actual table, and rows by which the two differ."""
    differing = quality.signed_difference(expected, actual, "__net").agg(
        F.coalesce(F.sum(F.abs("__net")), F.lit(0)).cast("long"))
    return actual.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", differing.scalar().alias("differing_rows"))


@query(f"SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differing_rows FROM ({_ORDERS_MERGED})")
def cdc_roundtrip(spark, sf):
    """Baseline plus diff feed is the new snapshot."""
    old, new = table(spark, sf, "orders"), _edited_orders(spark, sf)
    return _comparison(new, cdc.merge_changes(old, cdc.diff_snapshots(old, new, ["o_orderkey"]),
                                              ["o_orderkey"]))


@query(f"SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differing_rows FROM ({_ORDERS_MERGED})")
def cdc_replay(spark, sf):
    """Applying a feed twice changes nothing."""
    feed = orders_feed(spark, sf)
    once = cdc.merge_changes(table(spark, sf, "orders"), feed, ["o_orderkey"])
    return _comparison(once, cdc.merge_changes(once, feed, ["o_orderkey"]))


@query("""
SELECT event_id AS _seq, CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'I' ELSE 'U' END AS _op,
       user_id AS c_custkey
FROM events
WHERE event_id > (SELECT max(event_id) FROM events WHERE ts <= TIMESTAMP '2024-01-10')
""")
def feed_since(spark, sf):
    """Feed rows after the cursor a reader had on 10 January."""
    seen = date_range(table(spark, sf, "events"), end="2024-01-10", column="ts")
    cursor = seen.agg(F.max("event_id")).first()[0]
    return cdc.since(events_feed(spark, sf), cursor).select("_seq", "_op", "c_custkey")


@query("SELECT max(event_id) AS seq_high FROM events")
def feed_high_water(spark, sf):
    return cdc.high_water(events_feed(spark, sf))


@query("""
SELECT CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'I' ELSE 'U' END AS op, count(*) AS rows
FROM events GROUP BY 1
""")
def feed_op_counts(spark, sf):
    return cdc.op_counts(events_feed(spark, sf))


@query("""
WITH r AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i, count(*) OVER () AS total FROM events)
SELECT i // 1000 AS page, count(*) AS row_count, min(event_id) AS seq_low, max(event_id) AS seq_high,
       max(i) < max(total) - 1 AS truncated
FROM r GROUP BY 1
""")
def feed_pages(spark, sf):
    return cdc.feed_pages(events_feed(spark, sf), page_rows=1000)


@query("""
SELECT doc_id, lang, NULL::BIGINT AS n_chars FROM documents
UNION ALL
SELECT doc_id, NULL, n_chars FROM documents
""")
def feed_pages_union(spark, sf):
    """Pages whose columns differ, one after another."""
    docs = table(spark, sf, "documents")
    return readers.union_pages([docs.select("doc_id", "lang"), docs.select("n_chars", "doc_id")])


# --------------------------------------------------------------------------- reshape

_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _wide_lines(spark, sf) -> tuple[DataFrame, Layout]:
    """Lines with a missing measure: a zero discount is not recorded."""
    lines = table(spark, sf, "lineitem").select(
        *_LINE_KEY, "l_quantity", "l_extendedprice",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), "l_tax")
    return lines, Layout("wide", _LINE_KEY, _MEASURES)


_LONG_LINES = " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '{m}' AS measure, {v} AS value "
    f"FROM lineitem WHERE {v} IS NOT NULL"
    for m, v in ((m, "nullif(l_discount, 0)" if m == "l_discount" else m) for m in _MEASURES))


@query(_LONG_LINES)
def lineitem_to_long(spark, sf):
    return reshape.to_long(*_wide_lines(spark, sf))[0]


@query(f"""
SELECT *, CASE measure WHEN 'l_quantity' THEN 'LQ1' WHEN 'l_extendedprice' THEN 'LP1'
               WHEN 'l_tax' THEN 'LT1' END AS series_id
FROM ({_LONG_LINES})
""")
def lineitem_to_long_series(spark, sf):
    lines, layout = _wide_lines(spark, sf)
    ids = {"l_quantity": "LQ1", "l_extendedprice": "LP1", "l_tax": "LT1"}
    return reshape.to_long(lines, layout.but(series_ids=ids))[0]


def _daily_counts(spark, sf) -> tuple[DataFrame, Layout]:
    counts = (table(spark, sf, "events")
              .groupBy("user_id", F.to_date("ts").alias("date"), "event_type")
              .agg(F.count(F.lit(1)).alias("n")))
    return counts, Layout("long", ("user_id", "date", "event_type"), ("n",), ("date",), "event_type")


_EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def _wide_events(cell: str) -> str:
    cells = ", ".join(cell.format(f"count(*) FILTER (WHERE event_type = '{t}')") + f" AS {t}"
                      for t in _EVENT_TYPES)
    return f"SELECT user_id, CAST(ts AS DATE) AS date, {cells} FROM events GROUP BY 1, 2"


@query(_wide_events("nullif({}, 0)"))
def events_to_wide(spark, sf):
    return reshape.to_wide(*_daily_counts(spark, sf))[0]


@query(_wide_events("{}"))
def events_to_wide_fill(spark, sf):
    return reshape.to_wide(*_daily_counts(spark, sf), fill=0, names=_EVENT_TYPES)[0]


_MANY = [x + 0.5 for x in range(80)]


@query("SELECT l_orderkey, " + ", ".join(
    f"coalesce(sum(l_extendedprice) FILTER (WHERE l_partkey % 80 = {int(x)}), 0) AS \"{x}\"" for x in _MANY)
    + " FROM lineitem GROUP BY 1")
def lineitem_to_wide_many(spark, sf):
    """Eighty measures named by fractional numbers: the columns are named as with few."""
    lines = table(spark, sf, "lineitem")
    tasks = tasks_for(lines)
    cells = (lines.select("l_orderkey", "l_partkey", "l_extendedprice").repartition(tasks, "l_orderkey")
             .groupBy("l_orderkey", ((F.col("l_partkey") % 80) + 0.5).cast("double").alias("m"))
             .agg(F.sum("l_extendedprice").alias("v")))
    layout = Layout("long", ("l_orderkey",), ("v",), measure_name_column="m")
    return reshape.to_wide(cells, layout, fill=0.0, names=_MANY, tasks=tasks)[0]


@query("SELECT user_id, event_type, count(*) AS copies FROM events GROUP BY 1, 2 HAVING count(*) > 1")
def events_duplicate_cells(spark, sf):
    """The cells that keep a table from being widened."""
    return quality.duplicate_keys(table(spark, sf, "events"), ["user_id", "event_type"])


@query("""
SELECT user_id, CAST(ts AS DATE) AS date, event_type, count(*) AS n FROM events GROUP BY 1, 2, 3
""")
def reshape_roundtrip(spark, sf):
    """Long to wide and back, by the layouts the reshapes return."""
    wide, layout = reshape.to_wide(*_daily_counts(spark, sf))
    return reshape.to_long(wide, layout, names_to="event_type", values_to="n")[0]


# --------------------------------------------------------------------------- search, catalogue

_PART_ALIASES = {"fasteners": ("bolt", "gear", "Brand#12")}


@query("""
SELECT p_partkey, p_name, p_brand FROM part
WHERE contains(lower(p_name), 'bolt') OR contains(lower(p_name), 'gear') OR contains(lower(p_name), 'brand#12')
   OR contains(lower(p_brand), 'bolt') OR contains(lower(p_brand), 'gear') OR contains(lower(p_brand), 'brand#12')
""")
def search_part(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return search.search_rows(part, " Fasteners ", columns=("p_name",), long_columns=("p_brand",),
                              aliases=_PART_ALIASES)


@query("""
SELECT doc_id FROM documents
WHERE contains(lower(source), 'licen') OR contains(lower(source), 'copyright')
   OR contains(lower(source), 'all rights') OR contains(lower(source), 'permission')
   OR contains(lower(text), 'licen') OR contains(lower(text), 'copyright')
   OR contains(lower(text), 'all rights') OR contains(lower(text), 'permission')
""")
def search_documents(spark, sf):
    """Several needles over whole texts."""
    aliases = {"licence": ("licen", "copyright", "all rights", "permission")}
    return search.search_rows(table(spark, sf, "documents"), "licence", columns=("source",),
                              long_columns=("text",), aliases=aliases).select("doc_id")


@query("""
SELECT doc_id, source, lang FROM documents
WHERE contains(lower(source), 'licen') OR contains(lower(source), 'copyright')
   OR contains(lower(source), 'all rights') OR contains(lower(source), 'permission')
   OR contains(lower(text), 'licen') OR contains(lower(text), 'copyright')
   OR contains(lower(text), 'all rights') OR contains(lower(text), 'permission')
""")
def search_documents_indexed(spark, sf):
    """The same needles through trigram postings; the index is made of the documents in two parts."""
    path, docs = scratch_path(spark, "trigrams"), table(spark, sf, "documents")
    for part in (0, 1):
        textindex.add_rows(docs.filter(F.pmod("doc_id", F.lit(2)) == part), path, ["source", "text"])
    aliases = {"licence": ("licen", "copyright", "all rights", "permission")}
    return textindex.search_index(spark, path, "licence", columns=("source",), long_columns=("text",),
                                  aliases=aliases).select("doc_id", "source", "lang")


@query("""
SELECT p_partkey, p_name, CASE p_name WHEN 'small gizmo' THEN 0 WHEN 'red gizmo' THEN 1 ELSE 99 END AS rank
FROM part WHERE contains(lower(p_name), 'gizmo')
""")
def search_ranked(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    hits = search.search_rows(part, "Gizmo", columns=("p_name",), long_columns=("p_type",),
                              name_only=("gizmo",))
    return (search.ranked(hits, "gizmo", ranks={"gizmo": {"small gizmo": 0, "red gizmo": 1}}, name="p_name")
            .select("p_partkey", "p_name", "rank").orderBy("rank", "p_partkey"))


@query("""
SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'gizmo')
ORDER BY CASE p_name WHEN 'small gizmo' THEN 0 WHEN 'red gizmo' THEN 1 ELSE 99 END, p_partkey
LIMIT 50
""")
def search_capped(spark, sf):
    """The first hits of a ranked search, at most fifty."""
    return limits.first_n(search_ranked(spark, sf), limits.capped_limit(80, 50),
                          ["rank", "p_partkey"]).select("p_partkey", "p_name")


def catalog_of_documents(spark: SparkSession, sf: str) -> DataFrame:
    """A catalogue with one dataset per source and language of ``documents``."""
    lang = F.col("lang")
    return (table(spark, sf, "documents").groupBy("source", "lang")
            .agg(F.sum("n_chars").alias("row_count_at_last_refresh"))
            .select(
                F.concat_ws("_", "source", "lang").alias("name"),
                F.concat(F.lit("Texts of "), F.col("source")).alias("title"),
                "source", lang.alias("namespace"), "row_count_at_last_refresh",
                F.when(lang == "en", "Materialised").when(lang == "fr", "none").when(lang == "es", "")
                .alias("bulk_export_class"),
                F.when(lang == "de", "point").when(lang == "fr", "none").alias("geometry_type"),
                (lang == "es").alias("has_geometry"),
                F.when(lang == "en", "CC-BY").when(lang == "de", "CC0").alias("licence"),
                F.when(lang == "en", "long").when(lang == "fr", "wide").when(lang == "de", "long")
                .otherwise("feature").alias("layout"),
                F.array(
                    F.struct(F.lit("value").alias("name"), F.lit(" amount ").alias("description")),
                    F.struct(F.when(lang == "en", "date").otherwise("start_date").alias("name"),
                             F.when(lang == "en", " day ").otherwise("  ").alias("description")),
                    F.struct(F.lit("value").alias("name"), F.lit("later entry").alias("description")),
                ).alias("columns")))


_CATALOG = """
WITH c AS (
  SELECT source || '_' || lang AS name, 'Texts of ' || source AS title, source, lang AS namespace,
         CAST(sum(n_chars) AS BIGINT) AS row_count,
         CASE lang WHEN 'en' THEN 'Materialised' WHEN 'fr' THEN 'none' WHEN 'es' THEN '' END AS bulk_class,
         CASE lang WHEN 'de' THEN 'point' WHEN 'fr' THEN 'none' END AS geometry_type,
         lang = 'es' AS has_geometry,
         CASE lang WHEN 'en' THEN 'CC-BY' WHEN 'de' THEN 'CC0' END AS licence,
         CASE lang WHEN 'en' THEN 'long' WHEN 'fr' THEN 'wide' WHEN 'de' THEN 'long' ELSE 'feature' END AS layout,
         lang
  FROM documents GROUP BY source, lang)
"""


@query(_CATALOG + "SELECT name, title, source, namespace FROM c WHERE source = 'src3'")
def catalog_list(spark, sf):
    return search.compact_hits(from_source(catalog_of_documents(spark, sf), "src3"))


@query(_CATALOG + """
SELECT name, title, source, namespace FROM c WHERE contains(name, 'src1') OR contains(lower(title), 'src1')
""")
def catalog_search(spark, sf):
    return search.compact_hits(search.search_catalog(catalog_of_documents(spark, sf), "SRC1"))


@query(_CATALOG + """
SELECT name, source, namespace, title, bulk_class AS bulk_export_class, geometry_type, has_geometry,
       row_count AS row_count_at_last_refresh, licence, layout FROM c
""")
def catalog_table_fields(spark, sf):
    return cat.table_fields(catalog_of_documents(spark, sf))


@query(_CATALOG + """
SELECT name, CASE WHEN coalesce(geometry_type, '') NOT IN ('', 'none') OR has_geometry
                  THEN 'geoparquet' ELSE 'parquet' END AS format FROM c
""")
def catalog_formats(spark, sf):
    return cat.with_format(catalog_of_documents(spark, sf)).select("name", "format")


@query(_CATALOG + """
SELECT name, lower(coalesce(bulk_class, '')) NOT IN ('', 'none') AS bulk_allowed,
       lower(coalesce(bulk_class, '')) = 'none' AS bulk_refused,
       CASE WHEN lower(coalesce(bulk_class, '')) NOT IN ('', 'none') AND (has_geometry OR row_count > 100000)
            THEN 'bulk' ELSE 'live' END AS route FROM c
""")
def catalog_routes(spark, sf):
    return cat.with_route(catalog_of_documents(spark, sf)).select(
        "name", "bulk_allowed", "bulk_refused", "route")


@query(_CATALOG + """
SELECT name,
       CASE WHEN coalesce(geometry_type, '') NOT IN ('', 'none') OR has_geometry
            THEN 'geoparquet' ELSE 'parquet' END AS format,
       CASE WHEN lower(coalesce(bulk_class, '')) NOT IN ('', 'none') AND row_count > 100000
            THEN 'bulk' ELSE 'live' END AS route,
       lower(coalesce(bulk_class, '')) NOT IN ('', 'none') AS bulk_allowed,
       lower(coalesce(bulk_class, '')) = 'none' AS bulk_refused,
       CASE lang WHEN 'en' THEN 'date' ELSE 'start_date' END AS date_column, layout,
       CASE WHEN coalesce(geometry_type, '') NOT IN ('', 'none') OR has_geometry OR layout = 'feature' THEN 'refused'
            WHEN layout = 'wide' THEN 'to_long' ELSE 'to_wide' END AS reshape
FROM c
""")
def catalog_audit(spark, sf):
    return cat.audit(catalog_of_documents(spark, sf), geometry=False)


@query(_CATALOG + """
SELECT name AS dataset, position, CASE position WHEN 1 THEN CASE lang WHEN 'en' THEN 'date' ELSE 'start_date' END
       ELSE 'value' END AS name,
       CASE position WHEN 0 THEN ' amount ' WHEN 1 THEN CASE lang WHEN 'en' THEN ' day ' ELSE '  ' END
       ELSE 'later entry' END AS description
FROM c, (VALUES (0), (1), (2)) p(position)
""")
def catalog_glossary(spark, sf):
    return cat.glossary(catalog_of_documents(spark, sf))


@query(_CATALOG + """
SELECT name AS dataset, 'value' AS name, 'amount' AS label FROM c
UNION ALL
SELECT name, CASE lang WHEN 'en' THEN 'date' ELSE 'start_date' END, CASE lang WHEN 'en' THEN 'day' END FROM c
""")
def catalog_column_labels(spark, sf):
    return cat.column_labels(cat.glossary(catalog_of_documents(spark, sf)))


@query(_CATALOG + "SELECT source, licence, count(*) AS datasets FROM c GROUP BY ALL")
def licence_rollup(spark, sf):
    return cat.licence_rollup(catalog_of_documents(spark, sf))


@query(_CATALOG + """
SELECT d.doc_id, d.dataset, c.title, c.licence
FROM (SELECT doc_id, source || '_' || CASE WHEN n_chars > 5000 THEN 'xx' ELSE lang END AS dataset FROM documents) d
LEFT JOIN c ON c.name = d.dataset
""")
def metadata_attach(spark, sf):
    """Rows of several datasets get catalogue fields; unknown datasets get nulls."""
    lang = F.when(F.col("n_chars") > 5000, "xx").otherwise(F.col("lang"))
    docs = table(spark, sf, "documents").select("doc_id", F.concat_ws("_", F.col("source"), lang).alias("dataset"))
    catalog = cut_lineage(catalog_of_documents(spark, sf), "catalog")  # computed once, then measured and joined
    return cat.attach_metadata(docs, catalog, "dataset", ["title", "licence"])


@query("""
WITH p AS (SELECT CAST(o_custkey AS VARCHAR) AS name,
                  CASE o_orderstatus WHEN 'P' THEN '' ELSE 'status ' || o_orderstatus END AS licence
           FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1),
c AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN 'new ' ELSE '' END || c_custkey AS name, c_name AS title, c_mktsegment AS licence FROM customer
)
SELECT coalesce(c.name, p.name) AS name, title, coalesce(nullif(p.licence, ''), c.licence) AS licence
FROM c FULL JOIN p ON c.name = p.name
""")
def provenance_override(spark, sf):
    """A record's own provenance wins over the catalogue's, unless it is blank."""
    name = F.concat(F.when(F.col("c_custkey") % 3 == 0, "new ").otherwise(""), F.col("c_custkey").cast("string"))
    customers = table(spark, sf, "customer").select(
        name.alias("name"), F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("licence"))
    status = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("status "), F.col("o_orderstatus")))
    latest = (table(spark, sf, "orders").groupBy("o_custkey")
              .agg(F.max_by(F.coalesce(status, F.lit("")), "o_orderkey").alias("licence"))
              .select(F.col("o_custkey").cast("string").alias("name"), "licence"))
    return cat.override_provenance(customers, latest)


@query("""
WITH e AS (SELECT lang, min(source) AS expected_source FROM documents GROUP BY lang)
SELECT d.doc_id, d.lang, nullif(d.source, 'src3') AS source, e.expected_source
FROM documents d JOIN e USING (lang)
WHERE d.source <> 'src3' AND d.source <> e.expected_source
""")
def source_mismatch(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", "lang", F.nullif("source", F.lit("src3")).alias("source"))
    expected = table(spark, sf, "documents").groupBy("lang").agg(F.min("source").alias("expected_source"))
    return quality.source_mismatch(docs, cut_lineage(expected, "expected"), ["lang"])


@query("""
SELECT doc_id, 'documents' AS source, nullif(trim(CASE WHEN doc_id % 4 = 0 THEN '  ' ELSE lang END), '') AS lang,
       CASE WHEN length(text) > 30 THEN left(text, 27) || '...' ELSE text END AS text
FROM documents
""")
def labelled_rows(spark, sf):
    """Source label, blank text as null, cut text."""
    docs = table(spark, sf, "documents").withColumn("lang", F.when(F.col("doc_id") % 4 == 0, "  ").otherwise(F.col("lang")))
    return cat.with_source(docs, "documents").select(
        "doc_id", "source", blank_to_null(F.col("lang")).alias("lang"), truncated(F.col("text"), 30).alias("text"))


# --------------------------------------------------------------------------- geometry

def _shapes(spark, sf) -> DataFrame:
    """WKT from line numbers: boxes, points, empty shapes and broken text."""
    x0, y0 = F.col("l_quantity"), F.col("l_extendedprice")
    x1, y1 = F.col("l_quantity") + F.col("l_linenumber"), F.col("l_extendedprice") + F.col("l_tax")
    ring = F.concat_ws(", ", *[F.concat_ws(" ", a, b) for a, b in
                               ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))])
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    wkt = (F.when((flag == "A") & (status == "F"), F.lit("POLYGON EMPTY"))
           .when(flag == "A", F.concat(F.lit("POINT Z ("), F.concat_ws(" ", x0, y0, x1), F.lit(")")))
           .when((flag == "R") & (status == "F"), F.concat(F.lit("POLYGON (("), ring, F.lit(" oops))")))
           .otherwise(F.concat(F.lit("POLYGON (("), ring, F.lit("))"))))
    return table(spark, sf, "lineitem").select(*_LINE_KEY, wkt.alias("geometry_wkt"))


_BOXES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS xmin, l_extendedprice AS ymin,
       CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE l_quantity + l_linenumber END AS xmax,
       CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE l_extendedprice + l_tax END AS ymax
FROM lineitem WHERE NOT (l_returnflag IN ('A', 'R') AND l_linestatus = 'F')
"""


@query(_BOXES + """
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, NULL, NULL, NULL, NULL
FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linestatus = 'F'
""")
def wkt_envelope(spark, sf):
    return geo.envelope(_shapes(spark, sf)).drop("geometry_wkt")


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM ({_BOXES})
WHERE xmin >= 10 AND ymin >= 20000 AND xmax <= 30 AND ymax <= 60000
""")
def wkt_bbox(spark, sf):
    return geo.within_bbox(_shapes(spark, sf), 10, 20000, 30, 60000).drop("geometry_wkt")


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM ({_BOXES})
WHERE xmin >= 10 AND ymin >= 20000 AND xmax <= 30 AND ymax <= 60000
""")
def bbox_by_place(spark, sf):
    """The same box on a table written in the order of a curve, with the boxes as columns."""
    path = scratch_path(spark, "places")
    geo.write_by_place(_shapes(spark, sf), path, bounds=(0, 0, 60, 120_000))
    return geo.within_bbox(readers.read_table(spark, path), 10, 20000, 30, 60000).select(*_LINE_KEY)


# --------------------------------------------------------------------------- checks

@query("""
SELECT source, lang, count(*) AS copies FROM documents GROUP BY 1, 2 HAVING count(*) >= 0.02 * (SELECT count(*) FROM documents)
""")
def hot_keys_documents(spark, sf):
    """Sources and languages that hold a fiftieth of all documents or more."""
    return hotkeys.hot_keys(table(spark, sf, "documents"), ["source", "lang"], 0.02).drop("share")


@query("""
SELECT o_custkey, count(*) AS copies FROM orders GROUP BY 1 HAVING count(*) >= 0.0005 * (SELECT count(*) FROM orders)
""")
def hot_keys_orders(spark, sf):
    """Customers with at least one in two thousand orders."""
    return hotkeys.hot_keys(table(spark, sf, "orders"), ["o_custkey"], 0.0005).drop("share")


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def duplicate_keys_lineitem(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT l_returnflag, l_linenumber, CAST(sum(n) AS BIGINT) AS net FROM (
  SELECT l_returnflag, l_linenumber, 1 AS n FROM lineitem WHERE l_linestatus = 'F'
  UNION ALL SELECT l_returnflag, l_linenumber, -1 FROM lineitem WHERE l_linestatus = 'O')
GROUP BY 1, 2 HAVING sum(n) <> 0
""")
def table_difference(spark, sf):
    """Few distinct rows with many copies each: copies are combined before the shuffle."""
    lines = table(spark, sf, "lineitem")
    part = lambda s: lines.filter(F.col("l_linestatus") == s).select("l_returnflag", "l_linenumber")
    return quality.signed_difference(part("O"), part("F"))


# --------------------------------------------------------------------------- sources and sinks

def _roundtrip(spark, sf, name: str, format: str) -> DataFrame:
    df = table(spark, sf, name)
    path = writers.write_table(df, scratch_path(spark, f"{name}-{format}"), format)
    return readers.read_table(spark, path, format, schema=df.schema)


@query("SELECT * FROM events")
def sink_parquet(spark, sf):
    return _roundtrip(spark, sf, "events", "parquet")


_AWKWARD = """
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '  ' || text || ' ' WHEN 1 THEN '' WHEN 2 THEN NULL
               WHEN 3 THEN '"' || replace(text, ' ', chr(13)) || ',' ELSE text END AS text, n_chars
FROM documents
"""


def _awkward_texts(spark, sf) -> DataFrame:
    """Texts with outer blanks, line breaks and quotes, empty texts and nulls."""
    text, kind = F.col("text"), F.col("doc_id") % 5
    awkward = (F.when(kind == 0, F.concat(F.lit("  "), text, F.lit(" "))).when(kind == 1, "").when(kind == 2, None)
               .when(kind == 3, F.concat(F.lit('"'), F.replace(text, F.lit(" "), F.lit("\r")), F.lit(","))).otherwise(text))
    return table(spark, sf, "documents").select("doc_id", awkward.alias("text"), "n_chars")


@query(_AWKWARD)
def sink_csv(spark, sf):
    texts = _awkward_texts(spark, sf)
    path = writers.write_table(texts, scratch_path(spark, "texts-csv"), "csv")
    return readers.read_table(spark, path, "csv", schema=texts.schema)


_CSV_FILE_BYTES = 512 << 20  # one task writes a file; that is several splits for those who read it


@query(_AWKWARD)
def sink_csv_split(spark, sf):
    """The same texts in one file per ``_CSV_FILE_BYTES``, whose splits are read side by side."""
    texts = _awkward_texts(spark, sf)
    files = max(1, -(-measured_bytes(texts) // _CSV_FILE_BYTES))
    path = writers.write_table(texts.coalesce(files), scratch_path(spark, "texts-csv"), "csv")
    return readers.read_table(spark, path, "csv", schema=texts.schema, split=True)


@query(_AWKWARD)
def sync_snapshot_csv_gz(spark, sf):
    """A table kept as gzip CSV holds what the snapshot held."""
    root = scratch_path(spark, "kept-csv")
    sync_snapshot(spark, root, _awkward_texts(spark, sf), "a", format="csv_gz")
    return VersionedTable(spark, root).read()


@query("SELECT * FROM events")
def sync_snapshot_orc(spark, sf):
    root = scratch_path(spark, "kept-orc")
    sync_snapshot(spark, root, table(spark, sf, "events"), "a", format="orc")
    return VersionedTable(spark, root).read()


@query("""
SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN NULL ELSE embedding[1] END AS first_value, embedding[2] AS second_value FROM embeddings
""")
def sink_records_nested(spark, sf):
    """NaN inside arrays and structs leaves as null, too."""
    first = F.when(F.col("vec_id") % 2 == 0, F.lit(float("nan")).cast("float")).otherwise(F.col("embedding")[0])
    nested = table(spark, sf, "embeddings").select("vec_id", F.struct(F.array(first, F.col("embedding")[1]).alias("v")).alias("s"))
    parsed = F.from_json("record", "vec_id long, s struct<v: array<float>>")
    return writers.to_records(nested).select(parsed.alias("r")).select(
        "r.vec_id", F.col("r.s.v")[0].alias("first_value"), F.col("r.s.v")[1].alias("second_value"))


@query("SELECT * FROM documents")
def sink_csv_gz(spark, sf):
    """Texts with line breaks and quotes through gzip CSV."""
    return _roundtrip(spark, sf, "documents", "csv_gz")


@query("SELECT * FROM documents")
def sink_json(spark, sf):
    return _roundtrip(spark, sf, "documents", "json")


@query("""
SELECT c_custkey, hex(encode('POINT (' || c_custkey || ' ' || c_nationkey || ')')) AS geometry FROM customer
""")
def sink_geoparquet(spark, sf):
    """Geometry stays binary on the way out and in."""
    shape = F.concat(F.lit("POINT ("), F.concat_ws(" ", "c_custkey", "c_nationkey"), F.lit(")"))
    shapes = table(spark, sf, "customer").select("c_custkey", F.encode(shape, "UTF-8").alias("geometry"))
    path = writers.write_table(shapes, scratch_path(spark, "shapes"), "geoparquet")
    return readers.read_table(spark, path, "geoparquet").withColumn("geometry", F.hex("geometry"))


@query("""
SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price
FROM orders
""")
def sink_records(spark, sf):
    """NaN leaves as null in JSON records, and null keys are kept."""
    price = F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", price.alias("price"))
    records = writers.to_records(orders)
    parsed = F.from_json("record", "o_orderkey long, o_orderpriority string, price double")
    return records.select(parsed.alias("r")).select("r.*")


def _payloads(spark, sf) -> str:
    """Record payloads with licences, at most a thousand rows each, one file per task."""
    pages = (with_row_index(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"),
                                ["o_orderkey"])
             .groupBy(F.floor(F.col("row_index") / 1000).alias("page"))
             .agg(F.collect_list(F.struct("o_orderkey", "o_custkey", "o_orderpriority")).alias("data"),
                  F.collect_set(F.struct(F.col("o_orderpriority").alias("name"),
                                         F.lit("CC-BY").alias("licence"))).alias("data_sources")))
    path = scratch_path(spark, "payloads")
    pages.write.option("maxRecordsPerFile", 1).json(path)
    return path


_RECORD = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                        T.StructField("o_orderpriority", T.StringType())])


@query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def record_payloads(spark, sf):
    return readers.read_records(spark, _payloads(spark, sf), _RECORD)


@query("SELECT DISTINCT o_orderpriority AS name, 'CC-BY' AS licence FROM orders")
def record_licences(spark, sf):
    return readers.read_envelope(spark, _payloads(spark, sf), _RECORD)[1]


# --------------------------------------------------------------------------- sync

_ORDERS_KEY = ["o_orderkey"]


@query(_ORDERS_MERGED)
def sync_changelog_batch(spark, sf):
    """Baseline with nothing in the feed yet, then the whole feed at once."""
    root = scratch_path(spark, "orders-table")
    orders, feed = table(spark, sf, "orders"), orders_feed(spark, sf)
    sync_changelog(spark, root, feed.limit(0), orders, key=_ORDERS_KEY, bucket_count=8)
    sync_changelog(spark, root, feed, orders, key=_ORDERS_KEY)
    return VersionedTable(spark, root).read()


@query(_ORDERS_MERGED)
def sync_changelog_stream(spark, sf):
    """The same feed, published in three parts and followed by a stream with one checkpoint; the baseline
    already holds the first part, with which the stream starts."""
    root, pages, checkpoint = (scratch_path(spark, f"orders-{p}") for p in ("table", "feed", "checkpoint"))
    orders, feed = table(spark, sf, "orders"), orders_feed(spark, sf)
    high = cdc.high_water(feed).first()["seq_high"]
    cuts = [0, high // 3, 2 * high // 3, high]
    history = cdc.since(feed, 0, cuts[1])
    sync_changelog(spark, root, history, cdc.merge_changes(orders, history, _ORDERS_KEY, keep="latest"),
                   key=_ORDERS_KEY, bucket_count=8)
    for low, upto in zip(cuts, cuts[1:]):
        cdc.since(feed, low, upto).write.mode("append").parquet(pages)
        stream = stream_changelog(read_feed_stream(spark, pages, feed.schema), root, checkpoint=checkpoint)
        stream.awaitTermination()
    return VersionedTable(spark, root).read()


@query(_SCD2_MERGED)
def sync_current_state(spark, sf):
    """History rows are kept out of the table from its baseline on."""
    root = scratch_path(spark, "versioned")
    state, feed = _versioned_orders(spark, sf)
    sync_changelog(spark, root, feed.limit(0), state, key=_ORDERS_KEY, bucket_count=8,
                   state_filter="is_current = true")
    sync_changelog(spark, root, feed, state)
    return VersionedTable(spark, root).read()


@query("""
SELECT strftime(o_orderdate, '%Y-%m') AS period, o_orderkey,
       o_totalprice + CASE WHEN o_orderdate >= TIMESTAMP '1998-06-01' THEN 1 ELSE 0 END AS o_totalprice
FROM orders
""")
def sync_by_period(spark, sf):
    """Buckets by month: changes to the latest months rewrite few buckets."""
    root = scratch_path(spark, "periods")
    orders = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("period"), "o_orderkey", "o_totalprice")
    feed = (orders.filter(F.col("period") >= "1998-06")
            .select((F.col("o_orderkey") + 1).alias("_seq"), F.lit("U").alias("_op"), "period", "o_orderkey",
                    (F.col("o_totalprice") + 1).alias("o_totalprice")))
    sync_changelog(spark, root, feed.limit(0), orders, key=["period", "o_orderkey"],
                   bucket_by=["period"], bucket_count=16)
    sync_changelog(spark, root, feed, orders)
    return VersionedTable(spark, root).read()


@query("SELECT o_orderkey, o_totalprice + 1 AS o_totalprice FROM orders")
def sync_snapshot_replace(spark, sf):
    """A second snapshot, of the same orders at other prices, replaces the first."""
    root = scratch_path(spark, "snapshot")
    for more in (0, 1):
        rows = table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") + more).alias("o_totalprice"))
        sync_snapshot(spark, root, rows, f"snapshot {more}")
    return VersionedTable(spark, root).read()


_OUTCOMES = """
WITH base AS (SELECT o_orderkey, o_totalprice FROM orders),
merged AS (SELECT o_orderkey, o_totalprice + CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 0 END AS o_totalprice
           FROM orders WHERE o_orderpriority <> '3-MEDIUM'
           UNION ALL SELECT -o_orderkey - 1, o_totalprice FROM orders WHERE o_orderpriority = '5-LOW'),
feed AS (SELECT sum(CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '4-NOT SPECIFIED' THEN 0 ELSE 1 END)::BIGINT AS ops,
                max(CASE o_orderpriority WHEN '1-URGENT' THEN o_orderkey * 2 + 2 WHEN '4-NOT SPECIFIED' THEN 0 ELSE o_orderkey * 2 + 1 END) AS high FROM orders)
"""


@query(_OUTCOMES + """
SELECT 'first' AS step, 'downloaded' AS status, 0::BIGINT AS ops, 0::BIGINT AS seq, * FROM base UNION ALL
SELECT 'nothing new', 'unchanged', 0, 0, * FROM base UNION ALL
SELECT 'feed', 'updated', ops, high, merged.* FROM merged, feed UNION ALL
SELECT 'feed again', 'unchanged', 0, high, merged.* FROM merged, feed UNION ALL
SELECT 'expired', 'updated', 0, high, o_orderkey, o_totalprice + 10 FROM base, feed UNION ALL
SELECT 'forced', 'downloaded', 0, high, o_orderkey, o_totalprice + 20 FROM base, feed
""")
def sync_changelog_outcomes(spark, sf):
    """A changelog table through every outcome of a sync: its rows after each, with what the sync reported."""
    root = scratch_path(spark, "outcomes")
    base = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    feed = orders_feed(spark, sf).select(*cdc.NAMES.all, "o_orderkey", "o_totalprice")
    meta = TableMeta.of({"name": "orders", "cdc_serving_tier": "changelog", "pk_columns": ["o_orderkey"]})
    dearer = lambda by: base.withColumn("o_totalprice", F.col("o_totalprice") + by)
    high = cdc.high_water(feed).first()["seq_high"]
    steps = [("first", base, feed.limit(0), {}), ("nothing new", base, feed.limit(0), {}), ("feed", base, feed, {}),
             ("feed again", base, feed, {}), ("expired", dearer(10), feed, {"retention_floor": high + 2}), ("forced", dearer(20), feed, {"force": True})]
    seen = []
    for step, snapshot, changes, options in steps:
        done = sync(spark, root, meta, snapshot, changes, bucket_count=4, **options)
        seen.append(VersionedTable(spark, root).read().select(
            F.lit(step).alias("step"), F.lit(done.status).alias("status"), F.lit(done.ops_applied or 0).cast("long").alias("ops"),
            F.lit(done.current_seq).cast("long").alias("seq"), "o_orderkey", "o_totalprice"))
    return reduce(DataFrame.unionByName, seen)


@query("""
WITH base AS (SELECT o_orderkey, o_totalprice FROM orders)
SELECT 'first' AS step, 'downloaded' AS status, * FROM base UNION ALL
SELECT 'same id', 'unchanged', * FROM base UNION ALL
SELECT 'forced', 'updated', o_orderkey, o_totalprice + 2 FROM base UNION ALL
SELECT 'no id', 'updated', o_orderkey, o_totalprice + 3 FROM base UNION ALL
SELECT 'no id again', 'updated', o_orderkey, o_totalprice + 4 FROM base
""")
def sync_snapshot_outcomes(spark, sf):
    """A snapshot table through every outcome; a blank id never counts as unchanged."""
    root = scratch_path(spark, "outcomes")
    base, seen = table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), []
    for by, (step, name, force) in enumerate((("first", "s1", False), ("same id", "s1", False), ("forced", "s1", True), ("no id", "", False),
                                              ("no id again", "", False))):
        meta = TableMeta.of({"name": "orders", "current_snapshot_id": name})
        done = sync(spark, root, meta, base.withColumn("o_totalprice", F.col("o_totalprice") + by), force=force)
        seen.append(VersionedTable(spark, root).read().select(F.lit(step).alias("step"), F.lit(done.status).alias("status"), "o_orderkey", "o_totalprice"))
    return reduce(DataFrame.unionByName, seen)


@query(_OUTCOMES + """
SELECT 1::BIGINT AS version, 'downloaded' AS status, 'changelog' AS sync_mode, NULL::BIGINT AS previous_seq, 0::BIGINT AS current_seq, 0::BIGINT AS ops_applied,
       (SELECT count(*) FROM base) AS rows_after UNION ALL
SELECT 2, 'updated', 'changelog', 0, high, ops, (SELECT count(*) FROM merged) FROM feed
""")
def sync_log_of_orders(spark, sf):
    """What the log says of a baseline and a merge, next to the rows that were there after each."""
    root = scratch_path(spark, "logged")
    base = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    feed = orders_feed(spark, sf).select(*cdc.NAMES.all, "o_orderkey", "o_totalprice")
    kept, rows = VersionedTable(spark, root), []
    for changes in (feed.limit(0), feed):
        sync_changelog(spark, root, changes, base, key=["o_orderkey"], bucket_count=4)
        commit = kept.commit()
        rows.append(kept.read(commit).agg(F.count(F.lit(1)).alias("rows_after")).withColumn("version", F.lit(commit.version).cast("long")))
    return (sync_log(spark, root).select("version", "status", "sync_mode", "previous_seq", "current_seq", "ops_applied")
            .join(reduce(DataFrame.unionByName, rows), "version"))


@query(_ORDERS_MERGED)
def sync_changelog_polled(spark, sf):
    """A stream that keeps polling: pages of the feed arrive while it runs, then it is stopped."""
    root, pages, checkpoint = (scratch_path(spark, f"polled-{p}") for p in ("table", "feed", "checkpoint"))
    orders, feed = table(spark, sf, "orders"), orders_feed(spark, sf)
    high = cdc.high_water(feed).first()["seq_high"]
    sync_changelog(spark, root, feed.limit(0), orders, key=_ORDERS_KEY, bucket_count=4)
    cdc.since(feed, 0, high // 2).write.parquet(pages)
    stream = stream_changelog(read_feed_stream(spark, pages, feed.schema), root, checkpoint=checkpoint, every="1s")
    try:
        stream.processAllAvailable()
        cdc.since(feed, high // 2).write.mode("append").parquet(pages)
        stream.processAllAvailable()
    finally:
        stream.stop()
    return VersionedTable(spark, root).read()
