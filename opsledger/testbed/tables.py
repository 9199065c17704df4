"""Maps the star-schema test tables onto the log, returns, ratings and graph inputs.

These stand in for the missing export files; every mapping is a row-wise expression or a key join
over whole tables, so it works on a stream of ``events`` as well as on a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opsledger.operators.compute import with_computed
from opsledger.operators.dedup import first_per_key
from opsledger.sources.files import read_table

YEAR = 2024
SURVIVOR_ORDER = ("line_no", "part_id", "supplier_id")
SUPPLIER_NODE_BASE = 1_000_000_000_000

# Known-error lines: message, code, where seen, note. The last line of a message wins.
ERROR_CODE_LINES = (
    "error code: stage aa, 100001, lab",
    "error code: stage ba, 100002, lab, first seen in spring",
    "warning: retry  pair id: p stage ca, 100003, porch",
    "frame 0 rendered, 100004, lab",
    "error code: stage aa, 100009, lab, replaces the first entry",
    "not a code line, none",
)
ERROR_PATTERNS = {
    "bound error": ("E svc_error", "error code", "stage b"),
    "crash dump": ("[", "crash dump", "info"),
    "retry": ("warning: retry",),
    "percent": ("100%",),
}


def _whole(column: str) -> Column:
    return F.floor(F.col(column)).cast("bigint")


def _text(value: Column) -> Column:
    return value.cast("string")


def device_records(events: DataFrame) -> DataFrame:
    """``topic, value, timestamp, key``: one device-log line per event, some of them damaged."""
    v, u, kind = _whole("value"), F.col("user_id"), F.col("event_type")
    stage = F.concat(F.char(97 + v % 26), F.char(97 + F.floor(v / 26) % 26))
    message = (
        F.when(kind == "error", F.concat(F.lit("error code:"), _text(v), F.lit(" stage "), stage))
        .when(kind == "signup", F.concat(F.lit("warning: retry "), _text(v), F.lit(" pair id: p"), _text(u),
                                         F.lit(" stage "), stage))
        .when(kind == "purchase", F.concat(F.lit(":: session_id: s"), _text(u), F.lit(" commit "), stage))
        .when(kind == "click", F.concat(F.lit("[::"), _text(v), F.lit("] crash dump "), stage, F.lit(" info")))
        .otherwise(F.concat(F.lit("frame "), _text(v), F.lit(" rendered")))
    )
    level = (
        F.when(kind == "error", "E").when(kind == "signup", "W").when(kind == "purchase", "D").otherwise("I")
    )
    full = F.date_format("ts", "MM-dd HH:mm:ss.SSSSSS")
    stamp = F.when(v % 11 == 3, "no-stamp").when(u % 3 == 0, F.substring(full, 1, 18)).otherwise(full)
    body = F.when(v % 13 == 5, "truncated").otherwise(F.concat(F.lit("svc_"), kind, F.lit(": "), message))
    line = F.concat_ws(" ", stamp, _text(10000 + u), F.lit("12345"), level, body)
    return with_computed(events, {"line": line}).select(
        F.concat(F.lit("device_"), _text(u % 30)).alias("topic"),
        F.col("line").alias("value"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("key"),
    )


def sentence_lines(events: DataFrame) -> DataFrame:
    """``<timestamp> code sentence.`` lines."""
    v = _whole("value")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    stamp = F.when(v % 11 == 3, "no-stamp").otherwise(stamp)
    sentence = F.concat(F.lit("The "), "event_type", F.lit(" took "), F.char(97 + v % 26), F.lit("."))
    return events.select(
        F.col("event_id").alias("key"),
        F.concat(F.lit("<"), stamp, F.lit("> "), _text(v), F.lit(" "), sentence).alias("value"),
    )


def access_lines(events: DataFrame, pages: DataFrame) -> DataFrame:
    """``key, value``: one combined-format access line per event, some of them damaged."""
    v, u, kind = _whole("value"), F.col("user_id"), F.col("event_type")
    n_pages = pages.agg(F.count("*").alias("n")).scalar()
    visits = events.withColumn("page_id", F.col("event_id") % n_pages).join(
        pages.select("page_id", "url"), "page_id"
    )
    ip = F.when(u % 10 == 0, "").otherwise(F.concat(F.lit("10.0."), _text(F.floor(u / 256)), F.lit("."), _text(u % 256)))
    date = F.when(v % 23 == 7, "bad date").otherwise(
        F.concat(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000"))
    )
    date = F.when(v % 19 == 6, "").otherwise(F.concat(F.lit(" ["), date, F.lit("]")))
    request = F.when(v % 29 == 8, "GET").otherwise(F.concat(F.lit("GET "), "url", F.lit(" HTTP/1.1")))
    status = (
        F.when(v % 17 == 4, "404").when(kind == "error", "500").when(kind == "signup", "302")
        .when(kind == "purchase", "201").otherwise("200")
    )
    size = F.when(v % 9 == 0, "-").otherwise(_text(v * 100))
    line = F.concat(
        ip, F.lit(" - user"), _text(u), date, F.lit(' "'), request, F.lit('" '), status, F.lit(" "), size,
        F.lit(' "-" "Browser/'), _text(u % 5), F.lit(' (test)"'),
    )
    return with_computed(visits, {"line": line}).select(F.col("event_id").alias("key"), F.col("line").alias("value"))


def alert_records(events: DataFrame) -> DataFrame:
    """``topic, value, timestamp, key`` with an alert payload per event."""
    v, u = _whole("value"), F.col("user_id")
    payload = F.concat(_text(v), F.lit(" "), "event_type", F.lit(" | 0X0100"), F.lpad(_text(u % 30), 4, "0"))
    return events.select(
        F.lit("alerts").alias("topic"), payload.alias("value"),
        F.col("ts").alias("timestamp"), F.col("event_id").alias("key"),
    )


def device_lines(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Device lookup lines ``name, ip, realm, model`` from the fixed nation and region tables."""
    key = _text(F.col("n_nationkey"))
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        F.concat(F.lit("device_"), key, F.lit(", 10.0."), key, F.lit(".1, "), "r_name", F.lit(", "), "n_name")
        .alias("value"),
        F.col("n_nationkey").alias("position"),
    )


def alert_lines(nation: DataFrame) -> DataFrame:
    """Quoted 13-field alert lines, some without engineer text and one without flags."""
    k = F.col("n_nationkey")
    flag = F.when(k == 7, "MAYBE").otherwise("TRUE")
    engineer = F.when(k % 5 == 0, "").otherwise(F.concat(F.lit('"Inspect '), "n_name", F.lit(', then retry"')))
    return nation.select(
        F.concat_ws(
            ",", _text(k), F.concat(F.lit("0x0100"), F.lpad(_text(k), 4, "0")), F.lit("FAMILY"), "n_name",
            F.lit("watch.cpp"), F.lit("Error"), F.lit("TRUE"), flag, F.lit("TRUE"), F.lit("stops"),
            F.lit('"Check it, please"'), F.lit("FALSE"), engineer,
        ).alias("value"),
        k.alias("position"),
    )


def error_code_lines(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"(:line{i}, {i})" for i in range(len(ERROR_CODE_LINES)))
    values = {f"line{i}": line for i, line in enumerate(ERROR_CODE_LINES)}
    return spark.sql(f"SELECT value, position FROM VALUES {rows} AS lines(value, position)", values)


def part_code_lines(part: DataFrame) -> DataFrame:
    """Known-error lines from parts, later parts with newer codes for the same message; every fifth has no code."""
    key = F.col("p_partkey")
    code = F.concat("p_name", F.lit(" error "), "p_brand", F.lit(", "), _text(100000 + key), F.lit(", lab"))
    value = F.when(key % 5 == 0, F.concat("p_name", F.lit(", none"))).otherwise(code)
    # the last line of a message counts, so files follow the keys
    return part.repartitionByRange("p_partkey").sortWithinPartitions("p_partkey").select(value.alias("value"))


def supplier_alert_lines(supplier: DataFrame) -> DataFrame:
    """Quoted 13-field alert lines from suppliers; every fourth is cut after its number."""
    k = F.col("s_suppkey")
    engineer = F.when(k % 5 == 1, "").otherwise(F.concat(F.lit('"Inspect '), "s_name", F.lit(', then retry"')))
    whole = F.concat_ws(
        ",", _text(k), F.concat(F.lit("0x0100"), _text(k)), F.lit("FAMILY"), "s_name", F.lit("watch.cpp"), F.lit("Error"),
        F.lit("TRUE"), F.when(k % 9 == 1, "MAYBE").otherwise("TRUE"), F.lit("TRUE"), F.lit("stops"), F.lit('"Check it, please"'),
        F.lit("FALSE"), engineer)
    return supplier.select(F.when(k % 4 == 0, _text(k)).otherwise(whole).alias("value"))


def customer_name_lines(customer: DataFrame) -> DataFrame:
    """``id "NAME"`` lines from customers, some without a name, some with a bad id."""
    k = F.col("c_custkey")
    quoted = F.concat(F.lit(' "'), "c_name", F.lit('"'))
    value = F.when(k % 6 == 0, _text(k)).when(k % 7 == 0, F.concat(F.lit("x"), _text(k), quoted)).otherwise(F.concat(_text(k), quoted))
    return customer.select(value.alias("value"))


def _described(lines: DataFrame, spark: SparkSession, folder: str, customers: bool) -> DataFrame:
    """Line-item rows as returns records; reports without customers skip that join."""
    orders = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    part = read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type", "p_size"
    )
    customer = read_table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    rows = lines.join(orders, "l_orderkey").join(part, "l_partkey")
    rows = rows.join(customer, "o_custkey") if customers else rows.withColumn("c_name", F.lit(None).cast("string"))

    kind = F.concat("l_returnflag", F.substring("o_orderpriority", 1, 1))
    category = (
        F.when(kind.isin("R1", "R2"), "Failed Unit").when(kind == "R3", "Loaner / Failed Unit")
        .when(kind == "R4", "Loaner Return").when(kind == "R5", "Eval Unit")
        .when(kind == "A1", "Unopened Return").when(kind == "A2", "Preemptive Return")
        .when(kind == "A3", "Return for Upgrade").when(kind == "A4", "Below Spec").when(kind == "A5", "Retrofit")
        .when(kind == "N1", "Recalibration").when(kind == "N2", "wrong sensor sent").when(kind == "N3", "None")
        .when(kind == "N4", "Swap Program")
        .when(F.col("l_linestatus") == "F", "Did not meet customer req").otherwise("Cancelled")
    )
    state = F.concat("o_orderstatus", "l_linestatus")
    status = (
        F.when(state == "FF", "Pending Receipt").when(state == "FO", "Pending Approval")
        .when(state == "OF", "Pending Receive").when(state == "OO", "Closed")
        .when(state == "PF", "RMA Cancelled").otherwise("Received")
    )
    name = F.col("p_name")
    display = (
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("ODU "), name))
        .when(F.col("p_type") == "SMALL", F.concat(F.lit("SINBON "), name))
        .when(F.col("p_type") == "MEDIUM", F.lit("OS-1 Sensor"))
        .when(F.col("p_type") == "PROMO", F.lit("OS1-64 No iBox"))
        .when(F.col("p_type") == "STANDARD", F.concat(F.lit("GEN2 "), name))
        .otherwise(F.concat(F.lit("Sinbon "), name))
    )
    case_no = F.lpad(_text(F.col("l_orderkey") % 1_000_000), 6, "0")
    return rows.select(
        F.concat_ws("-", _text(F.col("l_linenumber")), _text(F.col("l_partkey")), _text(F.col("l_suppkey")))
        .alias("internal_id"),
        F.concat(F.lit("RMA"), _text(F.col("l_orderkey"))).alias("document_number"),
        status.alias("status"),
        category.alias("category"),
        F.concat("p_brand", F.when(F.col("p_size") % 2 == 1, " GEN2").otherwise("")).alias("description"),
        display.alias("display_name"),
        (-F.col("l_quantity")).alias("quantity"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("created_at"),
        F.col("c_name").alias("customer"),
        F.concat(F.lit("CASE"), case_no, F.lit(" - "), name, F.lit(", "), "o_orderpriority").alias("case_text"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supplier_id"),
    )


def return_lines(spark: SparkSession, folder: str, customers: bool = False) -> DataFrame:
    """The returns export: several lines per document."""
    return _described(read_table(spark, folder, "lineitem"), spark, folder, customers)


def return_documents(spark: SparkSession, folder: str, customers: bool = False) -> DataFrame:
    """One surviving line per document.

    A document is an order, so the survivor is chosen on the line items themselves and only
    survivors meet the other tables; the order join reuses the grouping's partitioning.
    """
    lines = first_per_key(
        read_table(spark, folder, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"],
        ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"],
    )
    return _described(lines, spark, folder, customers)


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """``user, item, rating``: one to five stars per purchased line."""
    orders = read_table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return lines.join(orders, "l_orderkey").select(
        F.col("o_custkey").alias("user"),
        F.col("l_partkey").alias("item"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("rating"),
    )


def item_names(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(F.col("p_partkey").alias("item"), F.col("p_name").alias("name"))


def graph_lines(lineitem: DataFrame) -> DataFrame:
    """Adjacency lines linking orders, parts and (for returned lines) suppliers, both ways."""
    order = _text(-1 - F.col("l_orderkey"))
    part = _text(F.col("l_partkey"))
    supplier = _text(SUPPLIER_NODE_BASE + F.col("l_suppkey"))
    returned = F.col("l_returnflag") == "R"
    lines = F.array(
        F.when(returned, F.concat_ws(" ", order, part, supplier)).otherwise(F.concat_ws(" ", order, part)),
        F.concat_ws(" ", part, order),
        F.when(returned, F.concat_ws(" ", supplier, order)),
    )
    return lineitem.select(F.explode(lines).alias("value")).where(F.col("value").isNotNull())


def name_lines(part: DataFrame) -> DataFrame:
    """``id "NAME"`` lines; very small parts have no quoted name."""
    name = F.when(F.col("p_size") == 1, F.lit("")).otherwise(F.concat(F.lit(' "'), "p_name", F.lit('"')))
    return part.select(
        F.concat(_text(F.col("p_partkey")), name).alias("value"), F.col("p_partkey").alias("position")
    )
