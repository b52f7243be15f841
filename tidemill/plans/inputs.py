"""Inputs of the registered queries: the driver's tables, and the shop feeds that Spark derives from them.

Every feed uses the whole table it comes from. Its lines are JSON text, as a message queue would deliver them, so
the queries run the same parsing path as the streams do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.dates import millis_of_utc
from tidemill.operators.profile import encode_categories

PRIORITY_CODES = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 2, "5-LOW": 1}
#: Events that one task turns into lines and parses.
EVENTS_A_TASK = 20_000
SEGMENT_CODES = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2, "HOUSEHOLD": 3, "MACHINERY": 4}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(frame: DataFrame) -> DataFrame:
    """Give every core a share of an input that arrives in fewer splits than there are cores.

    For work that is heavy per row (JSON, regular expressions, Arrow). Large inputs pass through unchanged.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if frame.rdd.getNumPartitions() < cores else frame


def spread_events(spark: SparkSession, sf_dir: str, frame: DataFrame) -> DataFrame:
    """Deal rows made of events into tasks of about `EVENTS_A_TASK`, and at least one a core.

    A JSON line costs far more than the few bytes that splits and shuffles are sized by, so tasks cut by bytes would grow
    with the input. The number of events is in the file's footer.
    """
    events = table(spark, sf_dir, "events").count()
    return frame.repartition(max(spark.sparkContext.defaultParallelism, -(-events // EVENTS_A_TASK)))


def _event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_events(spark, sf_dir, _event_rows(spark, sf_dir))


def shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their millisecond time `ts_ms` and the product searched for, one part per event in turn.

    Dealt into tasks behind the join, which may be a shuffle that the adaptive planner merges into few tasks."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    parts = table(spark, sf_dir, "part").agg(F.count("*").alias("n"))
    events = _event_rows(spark, sf_dir).withColumn("ts_ms", millis_of_utc("ts")).withColumn("p_partkey", F.pmod("event_id", parts.scalar()))
    joined = events.join(part, "p_partkey").drop("p_partkey")
    return spread_events(spark, sf_dir, joined)


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page log with `common` and `page` maps and `ts`; every tenth page has no item."""
    kind = F.col("event_type")
    item = F.when(F.pmod("event_id", F.lit(10)) != 0, F.col("p_name"))
    error = kind == "error"
    return shop_events(spark, sf_dir).where(kind != "signup").select(
        F.create_map(F.lit("mid"), F.col("user_id").cast("string")).alias("common"),
        F.create_map(
            F.lit("item"), item,
            F.lit("item_type"), F.when(error, F.lit("sku_id")).otherwise(F.lit("keyword")),
            F.lit("last_page_id"), F.when(error, F.lit("home")).otherwise(F.lit("search")),
        ).alias("page"),
        F.col("ts_ms").alias("ts"),
    )


def app_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw application log lines `value`; about one in a hundred is cut short and no longer valid JSON."""
    kind, number = F.col("event_type"), F.col("event_id")
    is_new = F.when(kind.isin("signup", "view"), F.lit("1")).when(kind != "click", F.lit("0"))
    page = F.when(kind != "signup", F.struct(
        F.col("p_name").alias("item"),
        F.when(kind == "error", F.lit("sku_id")).otherwise(F.lit("keyword")).alias("item_type"),
        F.when(kind == "error", F.lit("home")).otherwise(F.lit("search")).alias("last_page_id"),
    ))
    shown = F.array(*[F.struct(F.lit(i).alias("pos"), F.col("p_name").alias("item")) for i in range(3)])
    displays = F.slice(shown, F.lit(1), F.pmod(number, F.lit(4)).cast("int"))
    done = F.array(*[F.struct(F.lit(i).alias("action_no"), kind.alias("action_id")) for i in range(2)])
    actions = F.slice(done, F.lit(1), F.pmod(number, F.lit(3)).cast("int"))
    line = F.to_json(F.struct(
        F.struct(F.col("user_id").cast("string").alias("mid"), is_new.alias("is_new"),
                 number.alias("seq")).alias("common"),
        page.alias("page"),
        F.when(kind == "signup", F.struct(F.lit("icon").alias("entry"))).alias("start"),
        F.when(kind == "error", F.struct(F.pmod(number, F.lit(7)).alias("error_code"))).alias("err"),
        displays.alias("displays"),
        actions.alias("actions"),
        F.col("ts_ms").alias("ts"),
    ))
    cut = F.pmod(number, F.lit(97)) == 0
    return shop_events(spark, sf_dir).select(
        F.when(cut, F.substring(line, F.lit(1), F.length(line) - 5)).otherwise(line).alias("value"))


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change envelopes `value` of one user table: signup creates, error deletes, everything else updates."""
    kind = F.col("event_type")
    image = F.struct("user_id", "event_type", "value")
    op = F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u")
    source = F.when(kind == "signup", "user_info").when(kind == "purchase", "order_info").otherwise("other")
    return _events(spark, sf_dir).select(F.to_json(F.struct(
        F.when(op == "d", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        F.struct(F.lit("shop").alias("db"), source.alias("table"), F.col("event_id").alias("pos")).alias("source"),
        op.alias("op"),
        millis_of_utc("ts").alias("ts_ms"),
    )).alias("value"))


def config_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change envelopes of the routing table: each event re-configures the source table named after its kind."""
    kind = F.col("event_type")
    row = F.struct(
        kind.alias("source_table"),
        F.concat(F.lit("dim_"), kind).alias("sink_table"),
        F.concat(F.lit("user_id,"), F.when(F.col("value") >= 10, "value").otherwise("event_type")).alias("sink_columns"),
        F.lit("user_id").alias("row_key"),
    )
    removed = F.col("value") < 0.5
    return _events(spark, sf_dir).select(F.to_json(F.struct(
        F.when(removed, row).alias("before"),
        F.when(~removed, row).alias("after"),
        F.struct(F.lit("shop_config").alias("db"), F.lit("table_process").alias("table"),
                 F.col("event_id").alias("pos")).alias("source"),
        F.when(removed, "d").otherwise("u").alias("op"),
        millis_of_utc("ts").alias("ts_ms"),
    )).alias("value"))


ROUTE_BATCHES = 6
ROUTED_KINDS = ["click", "error", "purchase", "signup", "view"]


def route_changes_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change envelopes `value` of one source table for each kind of event, cut by event into `ROUTE_BATCHES` equal
    `part`s; every 101st names no table."""
    kind, events = F.col("event_type"), _events(spark, sf_dir)
    total = table(spark, sf_dir, "events").agg(F.max("event_id") + 1)
    image = F.struct("user_id", "event_type", "value")
    named = F.when(F.pmod("event_id", F.lit(101)) != 0, kind)
    return events.select(F.floor(F.col("event_id") * ROUTE_BATCHES / total.scalar()).cast("int").alias("part"), F.to_json(F.struct(
        F.when(kind == "error", image).alias("before"), F.when(kind != "error", image).alias("after"),
        F.struct(F.lit("shop").alias("db"), named.alias("table"), F.col("event_id").alias("pos")).alias("source"),
        F.when(kind == "error", "d").otherwise("u").alias("op"), millis_of_utc("ts").alias("ts_ms"))).alias("value"))


def route_config_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration envelopes `value` by `part`. The k-th kind of event (one for each region) is configured in part k;
    an even one is removed in part k + 2 and comes back in part k + 3, an odd one gets other columns in part k + 4."""
    regions = table(spark, sf_dir, "region").where(F.col("r_regionkey").between(0, len(ROUTED_KINDS) - 1))
    k, even = F.col("r_regionkey"), F.pmod("r_regionkey", F.lit(2)) == 0
    kind = F.element_at(F.array(*[F.lit(x) for x in ROUTED_KINDS]), k + 1)
    entry = lambda part, op, columns: F.struct(part.alias("part"), F.lit(op).alias("op"), F.lit(columns).alias("columns"))
    plan = F.when(even, F.array(entry(k, "c", "user_id,value"), entry(k + 2, "d", "user_id,value"), entry(k + 3, "c", "user_id,event_type,value"))).otherwise(
        F.array(entry(k, "c", "user_id,event_type"), entry(k + 4, "u", "value")))
    rows = regions.select(kind.alias("kind"), F.inline(plan)).where(F.col("part") < ROUTE_BATCHES)
    row = F.struct(F.col("kind").alias("source_table"), F.concat(F.lit("dwd_"), "kind").alias("sink_table"),
                   F.col("columns").alias("sink_columns"), F.lit("user_id").alias("row_key"))
    return rows.select("part", F.to_json(F.struct(
        F.when(F.col("op") == "d", row).alias("before"), F.when(F.col("op") != "d", row).alias("after"),
        F.struct(F.lit("shop_config").alias("db"), F.lit("table_process").alias("table"), F.col("part").alias("pos")).alias("source"),
        "op", F.col("part").cast("bigint").alias("ts_ms"))).alias("value"))


def routes(spark: SparkSession) -> DataFrame:
    """Routing of the two configured source tables; records of any other table are dropped."""
    return spark.createDataFrame(
        [("user_info", "dim_user", "user_id,event_type", "user_id"),
         ("order_info", "dwd_order", "user_id,value", "user_id")],
        "source_table string, sink_table string, sink_columns string, row_key string",
    )


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary dimension `rk`, `info{dic_name, parent_code}` from the nations."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("rk"),
        F.struct(F.col("n_name").alias("dic_name"), F.col("n_regionkey").cast("string").alias("parent_code")).alias("info"))


def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numeric columns of the order lines."""
    return spread(table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax"))


def wide_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every component of the embeddings as a column `e0`, `e1` and so on; values below -0.15 are missing."""
    rows = table(spark, sf_dir, "embeddings")
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    return rows.select(*[F.when(at(i) >= -0.15, at(i)).alias(f"e{i}") for i in range(width)])


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with a 0/1 label (`response`: returned) and the order's priority and status."""
    lines = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
        "l_linestatus"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey").withColumn(
        "response", (F.col("l_returnflag") == "R").cast("int"))


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, with the buyer's balance and segment, category codes and a rare 0/1 label."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    buyers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    frame = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    frame = encode_categories(frame, "o_orderpriority", PRIORITY_CODES, "priority")
    frame = encode_categories(frame, "c_mktsegment", SEGMENT_CODES, "segment")
    rare = (F.col("o_orderstatus") == "P") & (F.col("priority") >= 4)
    return frame.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("premium"),
                        F.col("c_acctbal").alias("balance"), "priority", "segment", rare.cast("int").alias("response"))


def premiums(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Gross premium, ceded premium and equity per customer; customers may be missing from the first two."""
    orders = table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    gross = orders.groupBy(F.col("o_custkey").alias("policy")).agg((F.sum(cents) / 100).alias("gross"))
    ceded = orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("policy")).agg(
        (F.sum(cents) * 30 / 10000).alias("ceded"))
    equity = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("policy"), F.col("c_acctbal").alias("equity"))
    return gross, ceded, equity
