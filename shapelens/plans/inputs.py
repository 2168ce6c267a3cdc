"""Messages, landed rows and schemas derived from the test tables.

Every source row becomes at least one message, by expressions alone: no shuffle, no driver data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelens.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, dealt to all cores where its files cannot be split into as many tasks (one row group, say)."""
    rows = configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def _millis(column):
    return F.unix_millis(F.col(column).cast("timestamp"))


def _seconds(column):
    return F.unix_seconds(F.col(column).cast("timestamp"))


def event_json() -> Column:
    return F.to_json(F.struct(
        F.col("event_id").alias("id"), _millis("ts").alias("timestamp"), F.col("event_type").alias("eventType"),
        F.lit("1").alias("version"), F.col("user_id"), F.col("value"), F.from_json("props", "k bigint").alias("props")))


def _topic(number):
    return F.concat(F.lit("shop_"), (number % 3).cast("string"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean Kafka rows, one per event; the event id serves as offset."""
    events = table(spark, sf_dir, "events")
    return events.select(
        _topic(F.col("event_id")).alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), event_json().cast("binary").alias("value"))


def dirty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka rows with every defect the decoder handles; `event_id % 50` says which event gets which."""
    events = table(spark, sf_dir, "events")
    number, case = F.col("event_id"), F.col("event_id") % 50
    kind = F.concat(F.lit(',"eventType":"'), "event_type", F.lit('"'))
    text = F.concat(
        F.lit('{"id":'), number.cast("string"),
        F.when(case == 0, "").when(case == 3, F.concat(F.lit(',"timestamp":'), _seconds("ts").cast("string")))
        .otherwise(F.concat(F.lit(',"timestamp":'), _millis("ts").cast("string"))),
        F.when(case == 1, "").when(case == 10, F.lit(',"eventType":null')).otherwise(kind),
        F.when(case == 5, "").otherwise(F.lit(',"version":"1"')),
        F.lit(',"value":'), F.col("value").cast("string"), F.lit(',"props":'), "props",
        F.when(case == 2, "").otherwise(F.lit("}")),
    )
    value = (
        F.when(case == 9, F.lit(None).cast("string"))
        .when(case == 11, F.concat(F.lit("#"), F.md5(number.cast("string")), F.lit("-not-json")))
        .when(case == 12, "").when(case == 13, F.concat(F.lit("["), number.cast("string"), F.lit("]"))).otherwise(text)
    )
    topic = (F.when(case == 6, "_offsets").when(case == 7, "avro_schema").otherwise(_topic(number)))
    # case 4: an exact copy in the same topic; case 8: one in another topic
    copies = F.when(case == 4, F.array(F.struct(topic.alias("topic"), F.lit(0).alias("copy")), F.struct(topic.alias("topic"), F.lit(1).alias("copy")))) \
        .when(case == 8, F.array(F.struct(topic.alias("topic"), F.lit(0).alias("copy")),
                                 F.struct(_topic(number + 1).alias("topic"), F.lit(1).alias("copy")))) \
        .otherwise(F.array(F.struct(topic.alias("topic"), F.lit(0).alias("copy"))))
    return events.select(number.alias("number"), value.cast("binary").alias("value"), F.inline(copies)).select(
        "topic", (F.col("number") % 4).cast("int").alias("partition"),
        (F.col("number") + F.col("copy") * 1000000000).alias("offset"), "value")


def keyed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ids for keys: `seen` has an own key per event beside the field `total`, and what it holds again has
    an object with an own key."""
    events = table(spark, sf_dir, "events")
    number = F.col("event_id").cast("string")
    text = F.concat(
        F.lit('{"id":'), number, F.lit(',"timestamp":'), _millis("ts").cast("string"), F.lit(',"eventType":"'), F.col("event_type"), F.lit('","props":'), F.col("props"),
        F.lit(',"seen":{"total":'), F.col("user_id").cast("string"), F.lit(',"u'), number, F.lit('":{"n":'), F.col("value").cast("string"),
        F.when(F.col("event_id") % 3 == 0, "").otherwise(F.concat(F.lit(',"by.day":{"d'), (F.col("event_id") * 7).cast("string"), F.lit('":1,"x'), number, F.lit('":"y"}'))),
        F.lit("}}}"))
    return events.select(
        _topic(F.col("event_id")).alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), text.cast("binary").alias("value"))


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row key `<TYPE>-<epoch seconds>-<id>` and JSON text."""
    events = table(spark, sf_dir, "events")
    rowkey = F.concat_ws("-", F.upper("event_type"), _seconds("ts").cast("string"), F.col("event_id").cast("string"))
    return events.select(rowkey.alias("rowkey"), event_json().alias("json"))


def shipment_json() -> Column:
    """Line items as messages with nested objects, arrays of objects, arrays of scalars, nulls and absent fields."""
    charges = F.concat(
        F.lit("["),
        F.concat_ws(",",
                    F.when(F.col("l_discount") > 0, F.concat(F.lit('{"kind":"discount","rate":'), F.col("l_discount").cast("string"), F.lit("}"))),
                    F.when(F.col("l_tax") > 0, F.concat(F.lit('{"kind":"tax","rate":'), F.col("l_tax").cast("string"),
                                                        F.when(F.col("l_linestatus") == "F", ',"final":true').otherwise(""), F.lit("}")))),
        F.lit("]"))
    ints = lambda c: F.col(c).cast("string")
    return F.concat(
        F.lit('{"id":"'), ints("l_orderkey"), F.lit("-"), ints("l_linenumber"),
        F.lit('","timestamp":'), _millis("l_shipdate").cast("string"),
        F.lit(',"eventType":"'), F.when(F.col("l_returnflag") == "R", "return").otherwise("shipment"),
        F.lit('","item":{"part":'), ints("l_partkey"), F.lit(',"supplier":{"id":'), ints("l_suppkey"), F.lit("}}"),
        F.lit(',"price":'), F.col("l_extendedprice").cast("string"),
        F.lit(',"charges":'), charges,
        F.lit(',"codes":["'), F.col("l_returnflag"), F.lit('",'), ints("l_linenumber"), F.lit("]"),
        F.when(F.col("l_returnflag") == "N", ',"note":null').when(F.col("l_returnflag") == "A", ',"note":"ok"').otherwise(""),
        F.lit("}"))


def shipment_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.lit("warehouse").alias("topic"), F.col("l_linenumber").alias("partition"), F.col("l_orderkey").alias("offset"),
        shipment_json().cast("binary").alias("value"))


def landed_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    kind = F.when(F.col("l_returnflag") == "R", "RETURN").otherwise("SHIPMENT")
    rowkey = F.concat_ws("-", kind, F.lpad(_seconds("l_shipdate").cast("string"), 10, "0"),
                         F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"),
                         F.col("l_suppkey").cast("string"))
    return lines.select(rowkey.alias("rowkey"), shipment_json().alias("json"))


def schema_text() -> Column:
    """One Avro schema per customer: unions, an enum, arrays, a map, a record used by name."""
    return F.concat(
        F.lit('{"type":"record","name":"Account'), F.col("c_custkey").cast("string"), F.lit('","namespace":"shop","fields":['),
        F.lit('{"name":"id","type":"long"},'),
        F.lit('{"name":"balance","type":["null","double"]},'),
        F.lit('{"name":"segment","type":{"type":"enum","name":"Segment","symbols":["'), F.col("c_mktsegment"), F.lit('"]}},'),
        F.lit('{"name":"home","type":{"type":"record","name":"Address","fields":[{"name":"nation","type":"int"}'),
        F.when(F.col("c_acctbal") < 0, ',{"name":"owing","type":"float"}').otherwise(""), F.lit("]}},"),
        F.lit('{"name":"ship_to","type":["null","Address"]},'),
        F.lit('{"name":"orders","type":{"type":"array","items":{"type":"record","name":"Ref","fields":[{"name":"key","type":"string"}]}}},'),
        F.lit('{"name":"tags","type":{"type":"array","items":"string"}},'),
        F.lit('{"name":"attrs","type":{"type":"map","values":["null","long"]}}]}'))


def schema_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(schema_hash, schema_json)`; the hash is the MD5 text, 32 characters."""
    customers = table(spark, sf_dir, "customer")
    return customers.select(schema_text().alias("schema_json")).select(F.md5("schema_json").alias("schema_hash"), "schema_json")


def avro_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka rows `<schema hash><body>` of customers; in debt ones carry a hash that nobody registered."""
    customers = table(spark, sf_dir, "customer")
    hash_text = F.when(F.col("c_acctbal") < -500, F.md5(F.col("c_name"))).otherwise(F.md5(schema_text()))
    return customers.select(
        F.lit("accounts").alias("topic"), (F.col("c_custkey") % 4).cast("int").alias("partition"),
        F.col("c_custkey").alias("offset"), F.concat(hash_text.cast("binary"), F.unhex(F.hex("c_custkey"))).alias("value"))


def account_body() -> Column:
    return F.to_json(F.struct(
        F.col("c_custkey").alias("id"), (F.col("c_custkey") * 1000 + 1704067200000).alias("timestamp"),
        F.concat(F.lit("account_"), (F.col("c_nationkey") % 3).cast("string")).alias("eventType"), F.lit("1").alias("version"), F.col("c_acctbal").alias("balance")))


def account_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as messages of three types: type 0 all JSON, type 1 Avro under a registered schema, type 2 both; every
    tenth Avro message of type 1 has an unregistered hash, every twentieth an unreadable body."""
    customers = table(spark, sf_dir, "customer")
    kind, key = F.col("c_nationkey") % 3, F.col("c_custkey")
    avro = (kind == 1) | ((kind == 2) & (key % 2 == 0))
    hash_text = F.when((kind == 1) & (key % 10 == 0), F.md5(F.col("c_name"))).otherwise(F.md5(schema_text()))
    body = F.when((kind == 1) & (key % 20 == 1), F.lit("#")).otherwise(account_body())
    return customers.select(
        F.concat(F.lit("accounts_"), (key % 2).cast("string")).alias("topic"), (key % 4).cast("int").alias("partition"), key.alias("offset"),
        F.when(avro, F.concat(hash_text, body)).otherwise(body).cast("binary").alias("value"))


def json_body(body: Column, schema_hash: Column) -> Column:
    """Decoder of bodies in Avro's JSON encoding."""
    return body.cast("string")
