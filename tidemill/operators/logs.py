"""Application logs: validation, quarantine, and the five-way split.

A record is kept as a VARIANT, so fields this package has never heard of reach the outputs with their JSON types.
All functions are column expressions and take batch or streaming frames with a text column `value`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output tags and the record's fields.
ERROR, START, DISPLAY, ACTION, PAGE, DIRTY = "err", "start", "display", "action", "page", "dirty"
RECORD_FIELDS = ("common", "page", "start", "err", "displays", "actions", "ts")


def _get(path: str, kind: str = "variant", record: str = "record") -> Column:
    return F.try_variant_get(F.col(record), path, kind)


def _present(path: str) -> Column:
    """The field exists and is not JSON null."""
    return _get(path).isNotNull() & ~F.is_variant_null(_get(path))


def read_logs(lines: DataFrame) -> DataFrame:
    """Parse `value` into `record`, `mid`, `is_new`, `ts` and a `dirty_reason` that is null for a good record.

    Broken JSON, anything but an object, and records without device, time or common block are dirty.
    """
    parsed = lines.withColumn("record", F.try_parse_json("value"))
    fields = parsed.select(
        "*",
        _get("$.common.mid", "string").alias("mid"),
        _get("$.common.is_new", "string").alias("is_new"),
        _get("$.ts", "bigint").alias("ts"),
    )
    reason = (
        F.when(F.col("mid").isNotNull() & F.col("ts").isNotNull(), None)
        .when(_get("$", "map<string,variant>").isNull(), "not a JSON object")
        .when(_get("$.common", "map<string,variant>").isNull(), "no common block")
        .when(F.col("mid").isNull(), "no device")
        .otherwise("no time")
    )
    return fields.withColumn("dirty_reason", reason)


def valid_logs(logs: DataFrame) -> DataFrame:
    """Records of `read_logs` that parsed.

    Written as a Generate, because a filter would be pushed below the parse and parse every line twice.
    """
    good = F.when(F.col("dirty_reason").isNull(), F.array(F.struct("record", "mid", "is_new", "ts")))
    kept = [c for c in logs.columns if c not in ("record", "mid", "is_new", "ts", "dirty_reason")]
    return logs.select(*kept, F.inline(good))


def dirty_logs(logs: DataFrame) -> DataFrame:
    """The quarantine: raw line and reason."""
    return logs.where("dirty_reason IS NOT NULL").select("value", F.col("dirty_reason").alias("reason"))


def _members(value: Column) -> Column:
    """The members of an object as a map, JSON nulls left out as the shop's log format has it."""
    return F.map_filter(value.try_cast("map<string,variant>"), lambda k, v: ~F.is_variant_null(v))


def _object(value: Column) -> Column:
    """An object without its null members; any other value as it is."""
    members = _members(value)
    return F.when(members.isNotNull(), F.to_variant_object(members)).otherwise(value)


def _prepared(logs: DataFrame) -> DataFrame:
    """Add what the outputs share: the common and page blocks as JSON text, and whether the record must be rebuilt.

    Rebuilding maps is the costly part, so it is left to records that carry a JSON null or a repaired flag.
    """
    nulls = F.contains("value", F.lit("null"))
    flag = F.col("is_new")
    changed = flag.isNotNull() & ~flag.eqNullSafe(_get("$.common.is_new", "string"))
    members = _members(_get("$.common"))
    members = F.when(changed, F.map_concat(
        F.map_filter(members, lambda k, v: k != "is_new"),
        F.create_map(F.lit("is_new"), flag.cast("variant")),
    )).otherwise(members)
    common = F.when(nulls | changed, F.to_variant_object(members)).otherwise(_get("$.common"))
    page = F.when(nulls, _object(_get("$.page"))).otherwise(_get("$.page"))
    return logs.select(
        "*",
        nulls.alias("_nulls"),
        (nulls | changed).alias("_rebuild"),
        common.alias("_common"),
    ).select(
        "*",
        F.concat(F.lit('{"common":'), F.to_json("_common"),
                 F.when(_present("$.page"), F.concat(F.lit(',"page":'), F.to_json(page))).otherwise(F.lit("")),
                 ).alias("_head"),
        F.coalesce(F.size(_get("$.displays", "array<variant>")) > 0, F.lit(False)).alias("_displays"),
        F.coalesce(F.size(_get("$.actions", "array<variant>")) > 0, F.lit(False)).alias("_actions"),
        _present("$.start").alias("_start"),
        _present("$.err").alias("_err"),
    )


def _rebuilt(leave_out: Column | None = None) -> Column:
    """The record as JSON text from its members, with the shared common block."""
    members = F.map_filter(
        F.col("record").try_cast("map<string,variant>"),
        lambda k, v: (k != "common") & ~F.is_variant_null(v)
        if leave_out is None else (k != "common") & ~F.is_variant_null(v) & ~F.array_contains(leave_out, k),
    )
    members = F.when(F.col("_nulls"), F.transform_values(members, lambda k, v: _object(v))).otherwise(members)
    return F.to_json(F.to_variant_object(F.map_concat(members, F.create_map(F.lit("common"), F.col("_common")))))


def _line(tag: str, condition: Column, text: Column) -> Column:
    return F.when(condition, F.array(F.struct(F.lit(tag).alias("tag"), text.alias("value"))))


def _item_lines(tag: str, path: str, field: str, filled: str, with_time: bool) -> Column:
    """One line per array element: common and page blocks, the element, and the time where the output has one."""
    tail = F.concat(F.lit(',"ts":'), F.col("ts").cast("string"), F.lit("}")) if with_time else F.lit("}")

    def line(item: Column) -> Column:
        item = F.when(F.col("_nulls"), _object(item)).otherwise(item)
        text = F.concat(F.col("_head"), F.lit(f',"{field}":'), F.to_json(item), tail)
        return F.struct(F.lit(tag).alias("tag"), text.alias("value"))

    return F.when(~F.col("_start") & F.col(filled), F.transform(_get(path, "array<variant>"), line))


def _pieces() -> dict[str, Column]:
    whole = F.when(F.col("_rebuild"), _rebuilt()).otherwise(F.to_json("record"))
    emptied = F.array(F.when(F.col("_displays"), "displays").otherwise(""),
                      F.when(F.col("_actions"), "actions").otherwise(""))
    page = F.when(F.col("_rebuild") | F.col("_displays") | F.col("_actions"), _rebuilt(emptied)).otherwise(
        F.to_json("record"))
    return {
        ERROR: _line(ERROR, F.col("_err"), whole),
        START: _line(START, F.col("_start"), whole),
        DISPLAY: _item_lines(DISPLAY, "$.displays", "display", "_displays", with_time=True),
        ACTION: _item_lines(ACTION, "$.actions", "action", "_actions", with_time=False),
        PAGE: _line(PAGE, ~F.col("_start"), page),
    }


def _exploded(logs: DataFrame, lines: Column) -> DataFrame:
    return _prepared(logs).select(F.explode(lines).alias("line")).select("line.tag", "line.value")


def log_err(logs: DataFrame) -> DataFrame:
    """Whole records that carry an error; they also appear in the other outputs."""
    return _exploded(logs, _pieces()[ERROR]).select("value")


def log_start(logs: DataFrame) -> DataFrame:
    """Whole start records."""
    return _exploded(logs, _pieces()[START]).select("value")


def log_display(logs: DataFrame) -> DataFrame:
    """One line per displayed item of a page record: common, page, display, ts."""
    return _exploded(logs, _pieces()[DISPLAY]).select("value")


def log_action(logs: DataFrame) -> DataFrame:
    """One line per action of a page record: common, page, action."""
    return _exploded(logs, _pieces()[ACTION]).select("value")


def log_page(logs: DataFrame) -> DataFrame:
    """Page records without their displays and actions; an empty array stays."""
    return _exploded(logs, _pieces()[PAGE]).select("value")


def log_split(logs: DataFrame) -> DataFrame:
    """All outputs in one pass as (tag, value); dirty records, if still present, come under their own tag.

    One Generate over one parsed record replaces five filtered reads of the source.
    """
    none = F.array().cast("array<struct<tag:string,value:string>>")
    lines = F.concat(*[F.coalesce(piece, none) for piece in _pieces().values()])
    if "dirty_reason" in logs.columns:
        dirty = F.array(F.struct(F.lit(DIRTY).alias("tag"), F.col("value").alias("value")))
        lines = F.when(F.col("dirty_reason").isNull(), lines).otherwise(dirty)
    return _exploded(logs, lines)
