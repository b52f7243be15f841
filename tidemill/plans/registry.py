"""The registered queries: every operator over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import dates as D
from tidemill.functions import text as X
from tidemill.operators import changes as C
from tidemill.operators import keywords as K
from tidemill.operators import logs as L
from tidemill.operators import metrics as M
from tidemill.operators import models
from tidemill.operators import premiums as R
from tidemill.operators import profile as P
from tidemill.operators import resample as S
from tidemill.operators import stats as A
from tidemill.operators.skew import fits_broadcast
from tidemill.operators.gram import corr_matrix_wide as corr_wide
from tidemill.operators.visitors import repair_visitors
from tidemill.plans import inputs as I
from tidemill.plans.scratch import scratch_folder
from tidemill.sinks import writers as W
from tidemill.sinks.dimensions import DimensionFiles
from tidemill.sources import catalog, readers
from tidemill.sources.handover import SnapshotFiles
from tidemill.streaming import jobs
from tidemill.streaming.lateness import LateStore
from tidemill.streaming.routing import RouteStore
from tidemill.streaming.visitor_days import VisitorDays

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CATEGORIES = ["l_returnflag", "l_linestatus", "o_orderpriority"]
FEATURES = ["premium", "balance", "priority", "segment"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _json(path: str, kind: str = "string", column: str = "value"):
    return F.get_json_object(column, path).cast(kind)


def _rounded(frame: DataFrame, digits: int = 6) -> DataFrame:
    return frame.select(*[F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in frame.dtypes])


# Sources ------------------------------------------------------------------------------------------------------


@query
def kafka_json_table(spark, sf_dir):
    """A change topic as a SQL table."""
    rows = readers.change_table(spark, I.change_log(spark, sf_dir), "kafka_json_table_log")
    return rows.select("op", "ts_ms", C.source_position().alias("position"), C.source_table().alias("source_table"),
                       _json("$.user_id", "bigint", "before").alias("before_user"),
                       _json("$.user_id", "bigint", "after").alias("after_user"),
                       _json("$.value", "double", "after").alias("after_value"))


@query
def page_log_table(spark, sf_dir):
    """Page log lines as a table with maps and event time."""
    lines = W.as_lines(I.search_log(spark, sf_dir))
    rows = readers.page_log_table(lines)
    return rows.select(F.col("common")["mid"].alias("mid"), F.col("page")["item"].alias("item"),
                       F.col("page")["item_type"].alias("item_type"), "ts", F.unix_millis("et").alias("et_ms"))


@query
def change_log_source(spark, sf_dir):
    """Snapshot of the customers followed by the changes of one table."""
    changes = C.read_changes(I.change_log(spark, sf_dir))
    snapshot = readers.snapshot_changes(I.table(spark, sf_dir, "customer"), "shop", "user_info")
    whole = readers.change_source(changes, snapshot, ["shop"], ["shop.user_info"])
    return whole.select("op", "ts_ms", C.source_table().alias("source_table"),
                        _json("$.c_custkey", "bigint", "after").alias("customer"),
                        _json("$.user_id", "bigint", "after").alias("user_id"))


@query
def csv_source(spark, sf_dir):
    """A table written as CSV and read under its schema."""
    path = scratch_folder(spark, "csv")
    I.table(spark, sf_dir, "customer").write.csv(path, header=True)
    return readers.csv_table(
        spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")


@query
def dim_table_scan(spark, sf_dir):
    """A nested dimension table, created in the catalog, filled and read flat."""
    name = "dim_" + scratch_folder(spark, "scan").rsplit("-", 1)[1]
    catalog.create_dimension_table(spark, name, scratch_folder(spark, "dim"))
    I.dictionary(spark, sf_dir).write.insertInto(name)
    return readers.dimension_table(spark, name)


# Sinks and catalog --------------------------------------------------------------------------------------------


@query
def kafka_sink_records(spark, sf_dir):
    """Log split outputs as Kafka records, one topic per output."""
    topics = {tag: f"dwd_traffic_{tag}" for tag in (L.ERROR, L.START, L.DISPLAY, L.ACTION, L.PAGE, L.DIRTY)}
    split = L.log_split(L.read_logs(I.app_log(spark, sf_dir)))
    return _split_rows(W.routed_records(split, "tag", topics=topics), "topic")


@query
def routed_sink(spark, sf_dir):
    """Routed changes written to one folder per sink table and read back."""
    path = scratch_folder(spark, "routed")
    routed = C.route_changes(C.read_changes(I.change_log(spark, sf_dir)), I.routes(spark))
    W.routed_files(routed, path, "sink_table")
    return spark.read.parquet(path).select("sink_table", "op", "ts_ms", "row_key", *[
        _json(f"$.{c}", t, "payload").alias(c) for c, t in (("user_id", "bigint"), ("event_type", "string"), ("value", "double"))])


@query
def generic_sink(spark, sf_dir):
    """Rows serialised by a caller's expression."""
    rows = I.table(spark, sf_dir, "orders")
    return W.as_lines(rows, F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))


@query
def olap_json_sink(spark, sf_dir):
    """Keyword windows written as JSON lines by the batch writer, twice under one number, and read back."""
    path = scratch_folder(spark, "olap")
    result = K.keyword_window_count(I.search_log(spark, sf_dir).transform(K.with_event_time))
    write = W.json_batches(path)
    write(result, 0)
    write(result, 0)
    schema = "stt string, edt string, cur_date string, keyword string, keyword_count bigint"
    return spark.read.schema(schema).json(W.batch_folder(path, 0))


@query
def multi_sink(spark, sf_dir):
    """All log outputs written from one pass and read back."""
    path = scratch_folder(spark, "multi")
    W.tagged_batches(path)(L.log_split(L.read_logs(I.app_log(spark, sf_dir))), 0)
    return spark.read.parquet(W.batch_folder(path, 0)).groupBy("tag").agg(F.count("*").alias("n"))


@query
def dim_table_sink(spark, sf_dir):
    """Two batches of changes upserted into dimension files, folded, upserted again, read as current rows."""
    changes = _user_changes(spark, sf_dir)
    files = DimensionFiles(spark, scratch_folder(spark, "dimension"), "user_id", ["ts_ms", "position"], ["event_type", "value"])
    third = F.pmod(F.xxhash64("position"), F.lit(3))
    for number in range(3):
        files.upsert(changes.where(third == number), number)
        if number == 1:
            files.compact()
    return files.current().select("user_id", "event_type", "value", "ts_ms")


@query
def catalog_ddl(spark, sf_dir):
    """Tables of a namespace after the dictionary dimension was created in it."""
    namespace = "ns_" + scratch_folder(spark, "ns").rsplit("-", 1)[1]
    current = spark.catalog.currentDatabase()
    try:
        catalog.use_namespace(spark, namespace, scratch_folder(spark, "namespace"))
        catalog.create_dimension_table(spark, "dim_base_dic")
        I.dictionary(spark, sf_dir).write.insertInto("dim_base_dic")
        rows = spark.table(f"{namespace}.dim_base_dic").select(F.col("rk").alias("rk"))
        named = catalog.show_tables(spark, namespace).select(F.col("tableName").alias("table_name"))
        return named.select("table_name", rows.agg(F.count("*").alias("n")).scalar().alias("n"))
    finally:
        spark.sql(f"USE `{current}`")


# Change data --------------------------------------------------------------------------------------------------


def _user_changes(spark, sf_dir):
    changes = C.read_changes(I.change_log(spark, sf_dir)).withColumn("image", C.image())
    return changes.select("op", "ts_ms", C.source_position().alias("position"),
                          _json("$.user_id", "bigint", "image").alias("user_id"),
                          _json("$.event_type", "string", "image").alias("event_type"),
                          _json("$.value", "double", "image").alias("value"))


@query
def cdc_parse(spark, sf_dir):
    return _user_changes(spark, sf_dir)


@query
def cdc_clean(spark, sf_dir):
    changes = C.read_changes(I.change_log(spark, sf_dir)).withColumn("position", C.source_position())
    return C.clean_changes(changes, keep=["position"]).select(
        "position", "op", _json("$.user_id", "bigint", "before").alias("before_user"),
        _json("$.user_id", "bigint", "after").alias("after_user"))


@query
def cdc_config_state(spark, sf_dir):
    return C.config_state(I.config_log(spark, sf_dir))


@query
def cdc_route(spark, sf_dir):
    changes = C.read_changes(I.change_log(spark, sf_dir)).withColumn("position", C.source_position())
    return C.route_changes(changes, I.routes(spark)).select(
        "position", "op", "source_table", "sink_table", "row_key",
        _json("$.user_id", "bigint", "payload").alias("user_id"),
        _json("$.event_type", "string", "payload").alias("event_type"),
        _json("$.value", "double", "payload").alias("value"))


@query
def cdc_upsert_latest(spark, sf_dir):
    changes = _user_changes(spark, sf_dir)
    return C.latest_images(changes, "user_id", ["ts_ms", "position"], ["event_type", "value"]).select(
        "user_id", "event_type", "value", "ts_ms")


@query
def dim_table_autocreate(spark, sf_dir):
    """Sink tables present after the configuration log was applied to a new namespace."""
    namespace = "auto_" + scratch_folder(spark, "auto").rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE `{namespace}` LOCATION '{scratch_folder(spark, 'autocreate')}'")
    C.apply_table_config(spark, C.config_images(I.config_log(spark, sf_dir)), namespace)
    return catalog.show_tables(spark, namespace).select(F.col("tableName").alias("table_name"))


@query
def cdc_table_passthrough(spark, sf_dir):
    through = C.through_sql(spark, C.read_changes(I.change_log(spark, sf_dir)), "cdc_table_passthrough_log")
    return through.select("op", "ts_ms", C.source_position().alias("position"), *[
        _json(f"$.{c}", t, i).alias(f"{i}_{c}") for i in ("before", "after") for c, t in (("user_id", "bigint"), ("value", "double"))])


@query
def dim_enrich(spark, sf_dir):
    facts = I.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("code"))
    return C.enrich(facts, I.dictionary(spark, sf_dir), "code").select("c_custkey", "code", "dic_name", "parent_code")


# Behaviour logs -----------------------------------------------------------------------------------------------


def _good_logs(spark, sf_dir):
    logs = L.valid_logs(L.read_logs(I.app_log(spark, sf_dir)))
    return logs.withColumn("seq", F.try_variant_get("record", "$.common.seq", "bigint"))


@query
def log_parse_valid(spark, sf_dir):
    return _good_logs(spark, sf_dir).select("seq", "mid", "is_new", "ts")


@query
def log_dirty(spark, sf_dir):
    dirty = L.dirty_logs(L.read_logs(I.app_log(spark, sf_dir)))
    return dirty.select(F.regexp_extract("value", r'"seq":(\d+)', 1).cast("bigint").alias("seq"), "reason")


@query
def visitor_repair(spark, sf_dir):
    return repair_visitors(_good_logs(spark, sf_dir), ("ts", "seq")).select("seq", "mid", "ts", "is_new")


@query
def visitor_repair_documented(spark, sf_dir):
    fixed = repair_visitors(_good_logs(spark, sf_dir), ("ts", "seq"), "as_documented")
    return fixed.select("seq", "mid", "ts", "is_new")


_HEAD = (("seq", "$.common.seq", "bigint"), ("mid", "$.common.mid", "string"), ("is_new", "$.common.is_new", "string"))


def _fields(lines: DataFrame, *more: tuple[str, str, str]) -> DataFrame:
    return lines.select(*[_json(path, kind).alias(name) for name, path, kind in (*_HEAD, *more)])


@query
def log_err(spark, sf_dir):
    return _fields(L.log_err(_good_logs(spark, sf_dir)), ("error_code", "$.err.error_code", "bigint"),
                   ("item", "$.page.item", "string"), ("ts", "$.ts", "bigint"))


@query
def log_start(spark, sf_dir):
    return _fields(L.log_start(_good_logs(spark, sf_dir)), ("entry", "$.start.entry", "string"), ("ts", "$.ts", "bigint"))


@query
def log_display(spark, sf_dir):
    return _fields(L.log_display(_good_logs(spark, sf_dir)), ("item", "$.display.item", "string"),
                   ("pos", "$.display.pos", "bigint"), ("page_item", "$.page.item", "string"), ("ts", "$.ts", "bigint"))


@query
def log_action(spark, sf_dir):
    return _fields(L.log_action(_good_logs(spark, sf_dir)), ("action_id", "$.action.action_id", "string"),
                   ("action_no", "$.action.action_no", "bigint"), ("page_item", "$.page.item", "string"),
                   ("ts", "$.ts", "bigint"))


@query
def log_page(spark, sf_dir):
    return _fields(L.log_page(_good_logs(spark, sf_dir)), ("item", "$.page.item", "string"),
                   ("displays", "$.displays", "string"), ("actions", "$.actions", "string"), ("ts", "$.ts", "bigint"))


def _split_rows(lines: DataFrame, tag: str) -> DataFrame:
    """The fields of every line of the log outputs; a dirty line has none."""
    clean = ~F.col(tag).endswith(L.DIRTY)
    fields = {"seq": ("$.common.seq", "bigint"), "mid": ("$.common.mid", "string"), "is_new": ("$.common.is_new", "string"),
              "item": ("$.page.item", "string"), "entry": ("$.start.entry", "string"), "pos": ("$.display.pos", "int"),
              "shown": ("$.display.item", "string"), "action_no": ("$.action.action_no", "int"), "ts": ("$.ts", "bigint")}
    return lines.select(tag, *[F.when(clean, _json(p, t)).alias(c) for c, (p, t) in fields.items()])


def _split_counts(split: DataFrame) -> DataFrame:
    fields = split.select("tag", _json("$.common.is_new").alias("is_new"), _json("$.common.seq", "bigint").alias("seq"))
    return fields.groupBy("tag", "is_new").agg(F.count("*").alias("n"), F.sum("seq").alias("seqs"))


@query
def log_split(spark, sf_dir):
    """All outputs after the flag repair, counted by output and flag."""
    return _split_counts(L.log_split(repair_visitors(_good_logs(spark, sf_dir), ("ts", "seq"))))


@query
def log_split_rows(spark, sf_dir):
    """All outputs after the flag repair, line by line."""
    return _split_rows(L.log_split(repair_visitors(_good_logs(spark, sf_dir), ("ts", "seq"))), "tag")


# Keywords -----------------------------------------------------------------------------------------------------


def _searches(spark, sf_dir):
    return K.search_filter(I.search_log(spark, sf_dir).transform(K.with_event_time))


@query
def event_time(spark, sf_dir):
    return I.search_log(spark, sf_dir).transform(K.with_event_time).select("ts", F.unix_micros("et").alias("et_us"))


@query
def search_filter(spark, sf_dir):
    return _searches(spark, sf_dir).select("fullword", F.unix_millis("et").alias("et_ms"))


@query
def keyword_tokenize(spark, sf_dir):
    """Tokens of all documents, counted by token."""
    documents = I.spread(I.table(spark, sf_dir, "documents").select("text"))
    words = documents.select(F.explode(X.tokens("text")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query
def keyword_dictionary(spark, sf_dir):
    """Tokens of all documents cut by the best path through a word list (the short words of the benchmark), called from
    SQL and counted by token."""
    found = I.table(spark, sf_dir, "benchmark").select(F.explode(X.tokens("text")).alias("word")).where("length(word) BETWEEN 2 AND 4").distinct()
    if not fits_broadcast(found):
        raise ValueError("this word list is too long to broadcast")
    X.register_tokenizer(spark, "ik_dictionary", [r["word"] for r in found.collect()])
    I.spread(I.table(spark, sf_dir, "documents").select("text")).createOrReplaceTempView("keyword_dictionary_documents")
    return spark.sql("SELECT s.keyword AS word, count(*) AS n FROM keyword_dictionary_documents, LATERAL ik_dictionary(text) s(keyword) GROUP BY 1")


@query
def keyword_lateral(spark, sf_dir):
    """The SQL form: a lateral call of the registered table function."""
    X.register_tokenizer(spark)
    _searches(spark, sf_dir).createOrReplaceTempView("search_table")
    return spark.sql(
        "SELECT keyword, unix_millis(et) AS et_ms FROM search_table, LATERAL ik_analyze(fullword) t(keyword)")


@query
def keyword_window_count(spark, sf_dir):
    return K.keyword_window_count(I.search_log(spark, sf_dir).transform(K.with_event_time))


# Dates --------------------------------------------------------------------------------------------------------


@query
def date_helpers(spark, sf_dir):
    events = I.table(spark, sf_dir, "events").select("event_id", D.millis_of_utc("ts").alias("ms"))
    return events.select(
        "event_id", "ms", D.ts_to_date("ms").alias("date_text"), D.ts_to_datetime("ms").alias("datetime_text"),
        D.ts_to_partition("ms").alias("partition_text"), D.datetime_to_ts(D.ts_to_datetime("ms")).alias("datetime_ms"),
        D.date_to_ts(D.ts_to_date("ms")).alias("date_ms"))


@query
def window_format(spark, sf_dir):
    """Timestamps under a free pattern, and under a pattern without letters."""
    days = I.table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("day"))
    return days.select(D.window_format("day", "yyyy/MM/dd HH").alias("hour_text"),
                       D.window_format("day", "2024-12-11").alias("literal_text")).groupBy("hour_text", "literal_text").agg(
        F.count("*").alias("n"))


# Profiles -----------------------------------------------------------------------------------------------------


@query
def null_counts(spark, sf_dir):
    documents, labels = I.table(spark, sf_dir, "documents"), I.table(spark, sf_dir, "labels")
    # Only whether there is a text goes through the join.
    documents = documents.withColumn("text", F.when(F.col("text").isNotNull(), True))
    return P.null_counts(documents.join(labels, "doc_id", "left"))


@query
def frame_info(spark, sf_dir):
    return P.frame_info(I.table(spark, sf_dir, "orders"))


@query
def describe_numeric(spark, sf_dir):
    return _rounded(P.describe_numeric(I.line_numbers(spark, sf_dir), NUMBERS), 4)


@query
def describe_object(spark, sf_dir):
    return P.describe_object(I.sales(spark, sf_dir), CATEGORIES)


@query
def distinct_values(spark, sf_dir):
    return P.distinct_values(I.sales(spark, sf_dir), [*CATEGORIES, "l_linenumber"])


@query
def iqr_bounds(spark, sf_dir):
    return _rounded(P.iqr_bounds(I.line_numbers(spark, sf_dir), NUMBERS))


@query
def iqr_remove(spark, sf_dir):
    kept = P.iqr_remove(I.table(spark, sf_dir, "events"), ["value", "user_id"])
    return kept.select("event_id", "user_id", "value")


@query
def iqr_outliers(spark, sf_dir):
    return P.iqr_outliers(I.table(spark, sf_dir, "events"), ["value", "user_id"], keep=["event_id"])


@query
def box_stats(spark, sf_dir):
    return _rounded(P.box_stats(I.table(spark, sf_dir, "events"), ["value", "user_id"]))


@query
def encode_categories(spark, sf_dir):
    """Priorities coded in place; one of them has no code and becomes null."""
    codes = {k: v for k, v in I.PRIORITY_CODES.items() if k != "3-MEDIUM"}
    orders = I.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return P.encode_categories(orders, "o_orderpriority", codes)


@query
def drop_columns(spark, sf_dir):
    return P.drop_columns(I.table(spark, sf_dir, "customer"), "c_name", "c_acctbal")


@query
def head_rows(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return P.head_rows(orders, [F.desc("o_totalprice"), "o_orderkey"], 20)


# Statistics ---------------------------------------------------------------------------------------------------


@query
def value_counts(spark, sf_dir):
    return A.value_counts(I.table(spark, sf_dir, "lineitem"), "l_quantity")


@query
def value_shares(spark, sf_dir):
    return _rounded(A.value_shares(I.sales(spark, sf_dir), "o_orderpriority"))


@query
def crosstab_index(spark, sf_dir):
    return _rounded(A.crosstab(I.sales(spark, sf_dir), "o_orderpriority", "response", [0, 1], "index"))


@query
def crosstab_columns(spark, sf_dir):
    return _rounded(A.crosstab(I.sales(spark, sf_dir), "l_quantity", "response", [0, 1], "columns"))


@query
def crosstab_sorted(spark, sf_dir):
    return _rounded(A.crosstab_sorted(I.sales(spark, sf_dir), "l_linenumber", "response", [0, 1], 1))


@query
def group_median(spark, sf_dir):
    return _rounded(A.group_median(I.sales(spark, sf_dir), "response", "l_extendedprice"))


@query
def group_counts_2d(spark, sf_dir):
    return A.group_counts(I.sales(spark, sf_dir), "o_orderpriority", "response")


@query
def group_mean_ci(spark, sf_dir):
    return _rounded(A.group_mean_interval(I.sales(spark, sf_dir), ["o_orderpriority", "l_linestatus"], "response"), 5)


@query
def group_mean_bootstrap(spark, sf_dir):
    """The plots' interval: bootstrap means of the response by priority and line status."""
    found = A.group_mean_bootstrap(I.sales(spark, sf_dir), ["o_orderpriority", "l_linestatus"], "response", ["l_orderkey", "l_linenumber"])
    return _rounded(found, 5)


@query
def corr_matrix_wide(spark, sf_dir):
    """Correlations of all components of the embeddings; the lowest values of a component count as missing."""
    frame = I.wide_numbers(spark, sf_dir)
    return _rounded(corr_wide(frame, frame.columns))


@query
def corr_matrix(spark, sf_dir):
    return _rounded(A.corr_matrix(I.sales(spark, sf_dir), [*NUMBERS, "response"]))


@query
def corr_rank(spark, sf_dir):
    return _rounded(A.corr_rank(I.sales(spark, sf_dir), [*NUMBERS, "response"], "response"))


# Sampling, models, metrics ------------------------------------------------------------------------------------


@query
def train_test_split(spark, sf_dir):
    return S.with_test_flag(I.policies(spark, sf_dir), "id").select("id", "is_test")


@query
def class_counts(spark, sf_dir):
    return S.class_counts(I.policies(spark, sf_dir), "response")


@query
def smote_oversample(spark, sf_dir):
    """Synthetic rows of the rare class of all policies."""
    rows = S.synthetic_rows(I.policies(spark, sf_dir), "id", FEATURES, "response")
    return rows.select("base", "copy", *[F.round(c, 4).alias(c) for c in FEATURES], "response")


@query
def column_concat(spark, sf_dir):
    """Class counts after the synthetic rows joined the originals."""
    return S.class_counts(S.oversample(I.policies(spark, sf_dir), "id", FEATURES, "response"), "response")


def _scored(spark, sf_dir, fit):
    train, test = S.train_test_split(I.policies(spark, sf_dir), "id")
    balanced = S.oversample(train, "id", FEATURES, "response")
    return models.predict(fit(balanced, FEATURES, "response"), test)


@query
def boosted_classifier(spark, sf_dir):
    """Split, balance, fit boosted trees, score the test share."""
    scored = _scored(spark, sf_dir, lambda *a: models.fit_boosted(*a, rounds=10, depth=4))
    return scored.select("id", "response", "prediction")


@query
def tree_classifier(spark, sf_dir):
    return _scored(spark, sf_dir, models.fit_tree).select("id", "response", "prediction")


def _fitted(spark, sf_dir):
    """Both classifiers on the training share, and the test share."""
    train, test = S.train_test_split(I.policies(spark, sf_dir), "id")
    return {"boosted": models.fit_boosted(train, FEATURES, "response", rounds=10, depth=4),
            "tree": models.fit_tree(train, FEATURES, "response", depth=6)}, test


@query
def model_columns(spark, sf_dir):
    """Whether the rules of the fitted classifiers, as columns, predict what the classifiers do, for every test row."""
    fitted, test = _fitted(spark, sf_dir)
    for name, model in fitted.items():
        test = models.predict(model, test).withColumn(f"same_{name}", F.col("prediction").eqNullSafe(models.tree_rules(model).column())).drop("prediction")
    return test.select("id", "response", *[f"same_{name}" for name in fitted])


@query
def model_metrics(spark, sf_dir):
    """Scores and outcomes of the fitted classifiers on the test share."""
    fitted, test = _fitted(spark, sf_dir)
    found = None
    for name, model in fitted.items():
        scored = test.withColumn("prediction", models.tree_rules(model).column())
        outcomes = M.confusion_matrix(scored, "response", "prediction").agg(
            F.sum("n").alias("rows"), F.sum(F.when(F.col("actual") == 1, F.col("n"))).alias("positives"))
        row = M.classification_metrics(scored, "response", "prediction").select(F.lit(name).alias("classifier"), "*")
        row = row.withColumn("key", F.lit(1)).join(outcomes.withColumn("key", F.lit(1)), "key").drop("key")
        found = row if found is None else found.union(row)
    return _rounded(found)


def _guessed(spark, sf_dir):
    """Sales with a rule in place of a model: large discounted lines are guessed to come back."""
    guess = ((F.col("l_quantity") >= 30) & (F.col("l_discount") >= 0.03)).cast("int")
    return I.sales(spark, sf_dir).withColumn("guess", guess)


@query
def classification_metrics(spark, sf_dir):
    return _rounded(M.classification_metrics(_guessed(spark, sf_dir), "response", "guess"))


@query
def confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(_guessed(spark, sf_dir), "response", "guess")


# Premiums and text --------------------------------------------------------------------------------------------


@query
def column_bind(spark, sf_dir):
    return R.bind_by_key(list(I.premiums(spark, sf_dir)), "policy")


@query
def column_bind_position(spark, sf_dir):
    """Customers and orders side by side by row position."""
    customers = I.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    orders = I.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return R.bind_by_position([customers, orders], ["c_custkey", "o_orderkey"])


@query
def retained_premium_ratio(spark, sf_dir):
    bound = R.bind_by_key(list(I.premiums(spark, sf_dir)), "policy").na.fill(0.0, ["gross", "ceded"])
    return _rounded(R.retained_premium_ratio(bound, "gross", "ceded", "equity", keep=("policy",)), 4)


def _texts(spark, sf_dir):
    return I.spread(I.table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def longest_run(spark, sf_dir):
    return _texts(spark, sf_dir).select("doc_id", X.longest_run("text").alias("run"))


@query
def longest_run_min1(spark, sf_dir):
    return _texts(spark, sf_dir).select("doc_id", X.longest_run("text", zero_without_repeat=False).alias("run"))


@query
def longest_distinct_span(spark, sf_dir):
    return _texts(spark, sf_dir).select("doc_id", X.longest_distinct_span("text").alias("span"))


# Streams: the table's feed is written as files and read as a stream until it is used up ---------------------------


def _feed(spark, lines: DataFrame, name: str) -> DataFrame:
    path = scratch_folder(spark, name)
    lines.write.text(path)
    return readers.file_lines(spark, path, streaming=True)


@query
def watermark_zero(spark, sf_dir):
    """Streamed keyword windows; those that end after the newest event stay open."""
    lines = _feed(spark, W.as_lines(I.search_log(spark, sf_dir)), "search-feed")
    out = scratch_folder(spark, "keyword-windows")
    jobs.keyword_job(lines, out, scratch_folder(spark, "state"), until_done=True).start().awaitTermination()
    return spark.read.parquet(out)


@query
def stream_log_split(spark, sf_dir):
    """Streamed validation, flag repair and split, counted by output and flag."""
    jobs.use_rocksdb(spark)
    lines = _feed(spark, I.app_log(spark, sf_dir), "log-feed")
    numbered = lines.withColumn("seq", F.regexp_extract("value", r'"seq":(\d+)', 1).cast("bigint"))
    out = scratch_folder(spark, "log-outputs")
    jobs.log_split_job(numbered, scratch_folder(spark, "state"), out, ("ts", "seq"), until_done=True).start().awaitTermination()
    return _split_counts(spark.read.parquet(out).select("tag", "value"))


@query
def stream_dirty_logs(spark, sf_dir):
    """The quarantine of a live log stream, at the job's own checkpoint interval, stopped when the feed is used up."""
    lines = _feed(spark, I.app_log(spark, sf_dir), "dirty-feed")
    out = scratch_folder(spark, "dirty-logs")
    job = jobs.dirty_log_job(lines, out, scratch_folder(spark, "state")).start()
    try:
        job.processAllAvailable()
    finally:
        job.stop()
    return spark.read.schema("value string, reason string").parquet(out).select(
        F.regexp_extract("value", r'"seq":(\d+)', 1).cast("bigint").alias("seq"), "reason")


@query
def stream_dimension(spark, sf_dir):
    """Streamed upserts into dimension files."""
    files = DimensionFiles(spark, scratch_folder(spark, "stream-dimension"), "user_id", ["ts_ms", "position"],
                           ["event_type", "value"])
    lines = _feed(spark, I.change_log(spark, sf_dir), "change-feed")
    jobs.dimension_job(lines, files, scratch_folder(spark, "state"), until_done=True).start().awaitTermination()
    return files.current().select(F.col("user_id").cast("bigint").alias("user_id"), "event_type",
                                  F.col("value").cast("double").alias("value"), "ts_ms")


@query
def stream_route(spark, sf_dir):
    """Changes routed by a streamed configuration over several micro-batches: each in the batch and with the columns it
    arrived with, or still waiting, or without a table."""
    out, space = scratch_folder(spark, "stream-routed"), scratch_folder(spark, "stream-tables")
    name = "tide_" + space.rsplit("-", 1)[1]
    here = spark.catalog.currentDatabase()
    catalog.use_namespace(spark, name, space)
    spark.catalog.setCurrentDatabase(here)
    store = RouteStore(spark, scratch_folder(spark, "stream-route"), W.tagged_batches(out, "sink_table"), name)
    feeds = [(scratch_folder(spark, "route-feed"), f(spark, sf_dir)) for f in (I.route_config_feed, I.route_changes_feed)]
    state = scratch_folder(spark, "state")
    for part in range(I.ROUTE_BATCHES):
        for path, feed in feeds:
            feed.where(F.col("part") == part).select("value").write.mode("append").text(path)
        lines = [readers.file_lines(spark, path, streaming=True) for path, _ in feeds]
        jobs.stream_route_job(*lines, store, state, until_done=True).start().awaitTermination()
    tables = [r.tableName for r in catalog.show_tables(spark, name).collect()]
    spark.sql(f"DROP DATABASE {name} CASCADE")
    routed = spark.read.parquet(out).select(
        "source_table", F.col("sink_table").isin(tables).alias("has_table"), "batch", "sink_table", "op", "ts_ms", "row_key",
        *[_json(f"$.{c}", t, "payload").alias(c) for c, t in (("user_id", "bigint"), ("event_type", "string"), ("value", "double"))])
    left = store.waiting().select("source_table", "op", "ts_ms").unionByName(
        store.nameless().select("op", "ts_ms"), allowMissingColumns=True)
    return routed.unionByName(left, allowMissingColumns=True)


SNAPSHOT_CHUNKS = 8


@query
def snapshot_handover(spark, sf_dir):
    """A snapshot of the users, each chunk read at its own log position, followed on a stream by a log that starts before
    all of them."""
    lines = I.change_log(spark, sf_dir)
    changes = C.read_changes(lines).withColumn("position", C.source_position())
    changes = changes.withColumn("user_id", F.get_json_object(C.image(), "$.user_id").cast("bigint"))
    chunk = lambda key: F.pmod(key, F.lit(SNAPSHOT_CHUNKS)).cast("int")
    end = changes.agg(F.max("position"))
    handed = F.floor((F.col("chunk") + 2) * end.scalar() / 12)
    fields = changes.select("op", "ts_ms", "position", "user_id", F.get_json_object(C.image(), "$.event_type").alias("event_type"),
                            F.get_json_object(C.image(), "$.value").cast("double").alias("value"), chunk(F.col("user_id")).alias("chunk"))
    seen = fields.where(F.col("position") <= handed)
    users = C.latest_images(seen, "user_id", ["ts_ms", "position"], ["event_type", "value", "chunk"])
    files = SnapshotFiles(spark, scratch_folder(spark, "snapshot"), SNAPSHOT_CHUNKS)
    positions = spark.range(SNAPSHOT_CHUNKS).select(F.col("id").cast("int").alias("chunk")).select("chunk", handed.alias("position"))
    files.store(users.select("user_id", "event_type", "value", "chunk"), positions, "shop", "users")
    feed, out = scratch_folder(spark, "handover-feed"), scratch_folder(spark, "handover")
    late = C.source_position() >= F.floor(end.scalar() / 12)
    C.read_changes(lines).where(late).select(F.to_json(F.struct(
        "before", "after", "source", "op", "ts_ms")).alias("value")).write.text(feed)
    key = F.get_json_object(C.image(), "$.user_id").cast("bigint")
    write = lambda frame, number: frame.write.mode("overwrite").parquet(W.batch_folder(out, number))
    jobs.snapshot_job(readers.file_lines(spark, feed, streaming=True, files_per_trigger=4), files, chunk(key), scratch_folder(spark, "state"),
                      write, until_done=True).start().awaitTermination()
    return spark.read.parquet(out).select("op", "position", "chunk", *[
        F.get_json_object(C.image(), f"$.{c}").cast(t).alias(c) for c, t in (("user_id", "bigint"), ("event_type", "string"), ("value", "double"))])


VISITOR_PARTS = 10


@query
def stream_visitor_days(spark, sf_dir):
    """Streamed repair of the visitor flag, the log in ten parts that arrive two at a time, with a restart after each."""
    feed, out, state = (scratch_folder(spark, n) for n in ("visitor-feed", "visitor-days", "state"))
    lines = I.app_log(spark, sf_dir)
    number = F.regexp_extract("value", r'"seq":(\d+)', 1).cast("bigint")
    total = I.table(spark, sf_dir, "events").agg(F.max("event_id") + 1)
    parted = lines.withColumn("part", F.floor(number * VISITOR_PARTS / total.scalar()))
    held = scratch_folder(spark, "visitor-lines")
    parted.write.partitionBy("part").parquet(held)
    days = VisitorDays(spark, scratch_folder(spark, "visitor-state"), lambda frame, n: frame.write.mode("overwrite").parquet(W.batch_folder(out, n)),
                       ("ts", "seq"), compact_every=2)
    for part in range(0, VISITOR_PARTS, 2):
        rows = spark.read.schema("value string, part bigint").parquet(held).where(F.col("part").between(part, part + 1))
        rows.select("value").write.mode("append").text(feed)
        numbered = readers.file_lines(spark, feed, streaming=True).withColumn("seq", number)
        jobs.visitor_days_job(numbered, days, state, until_done=True).start().awaitTermination()
    return spark.read.parquet(out).select("seq", "mid", "ts", "is_new")


@query
def late_records(spark, sf_dir):
    """Searches that reach the stream out of order, split record by record into those in time and those whose ten-minute
    window had ended."""
    events = I.shop_events(spark, sf_dir)
    arrival = F.col("event_id") * 2 + F.when(F.pmod("event_id", F.lit(13)) == 0, 81).otherwise(0)
    total = I.table(spark, sf_dir, "events").agg(F.max("event_id") + 1)
    rows = events.select("event_id", F.col("ts_ms").alias("ts"), arrival.alias("offset"),
                         F.floor(arrival / (2 * total.scalar()) * 4).cast("int").alias("part"))
    feed, out, late, state = (scratch_folder(spark, n) for n in ("late-feed", "late-kept", "late-rows", "state"))
    held = scratch_folder(spark, "late-lines")
    rows.write.partitionBy("part").parquet(held)
    write = lambda path: lambda frame, n: frame.write.mode("overwrite").parquet(W.batch_folder(path, n))
    store = LateStore(spark, scratch_folder(spark, "late-state"), write(out), write(late))
    schema = "event_id bigint, ts bigint, offset bigint"
    for part in sorted(r["part"] for r in spark.read.parquet(held).select("part").distinct().collect()):
        spark.read.parquet(held).where(F.col("part") == part).select("event_id", "ts", "offset").write.mode("append").parquet(feed)
        jobs.late_records_job(spark.readStream.schema(schema).parquet(feed), store, state, until_done=True).start().awaitTermination()
    return spark.read.parquet(out).select("event_id", "ts", F.lit(False).alias("late")).union(
        spark.read.parquet(late).select("event_id", "ts", F.lit(True)))


@query
def open_windows(spark, sf_dir):
    """Streamed keyword windows, and those still open at the end of the run with their counts so far."""
    lines = _feed(spark, W.as_lines(I.search_log(spark, sf_dir)), "search-feed")
    out, state = scratch_folder(spark, "keyword-windows"), scratch_folder(spark, "state")
    jobs.keyword_job(lines, out, state, until_done=True).start().awaitTermination()
    closed = spark.read.parquet(out).withColumn("open", F.lit(False))
    return closed.unionByName(jobs.open_windows(spark, state).withColumn("open", F.lit(True)))
