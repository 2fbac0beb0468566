"""MERGE, versioned tables and the streaming upsert."""

from pyspark.sql import functions as F

from tablekeeper.functions.predicates import violations
from tablekeeper.operators import history
from tablekeeper.operators.delete import delete_above_percentile, delete_groups, delete_scoped, delete_where
from tablekeeper.operators.merge import Merge, source_checks, upsert
from tablekeeper.session import scratch_path
from tablekeeper.sources.files import write_parquet
from tablekeeper.sources.partitions import delete_in_place
from tablekeeper.sources.snapshots import SnapshotTable
from tablekeeper.streaming.keyed import KeyedLog
from tablekeeper.streaming.upsert import UpsertTable, read_file_stream, upsert_stream
from workloads.registry import query


def _changed_customers(load):
    """Every customer under a moved key, so that part of the keys is known and part is new."""
    return load("customer").select(
        (F.col("c_custkey") + 750).alias("c_custkey"),
        F.concat(F.lit("new-"), F.col("c_name")).alias("c_name"),
        "c_nationkey",
        (F.col("c_acctbal") + 1).alias("c_acctbal"),
        "c_mktsegment",
    )


@query(
    """WITH src AS (SELECT c_custkey+750 AS c_custkey, 'new-'||c_name AS c_name, c_nationkey,
    c_acctbal+1 AS c_acctbal, c_mktsegment FROM customer)
    SELECT t.* FROM customer t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.c_custkey=t.c_custkey)
    UNION ALL SELECT * FROM src"""
)
def merge_upsert(load):
    return upsert(load("customer"), _changed_customers(load), "c_custkey")


@query(
    """WITH src AS (SELECT c_custkey+750 AS k, c_acctbal AS bal FROM customer)
    SELECT coalesce(t.c_custkey,s.k) AS c_custkey,
    CASE WHEN t.c_custkey IS NULL OR s.bal>t.c_acctbal THEN s.bal ELSE t.c_acctbal END AS c_acctbal,
    t.c_mktsegment FROM customer t FULL JOIN src s ON s.k=t.c_custkey"""
)
def merge_conditional(load):
    customers = load("customer")
    source = customers.select((F.col("c_custkey") + 750).alias("k"), F.col("c_acctbal").alias("bal"))
    return (
        Merge(customers.select("c_custkey", "c_acctbal", "c_mktsegment"), source, {"c_custkey": "k"})
        .when_matched_update({"c_acctbal": "bal"}, when=lambda t, s: s("bal") > t("c_acctbal"))
        .when_not_matched_insert({"c_custkey": "k", "c_acctbal": "bal"})
        .result()
    )


@query(
    """WITH tgt AS (SELECT l_orderkey, l_linenumber, sum(l_quantity) AS l_quantity FROM lineitem
    GROUP BY ALL),
    src AS (SELECT l_orderkey+1000 AS l_orderkey, l_linenumber, sum(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL)
    SELECT coalesce(t.l_orderkey,s.l_orderkey) AS l_orderkey, coalesce(t.l_linenumber,s.l_linenumber) AS l_linenumber,
    coalesce(t.l_quantity,0)+coalesce(s.l_quantity,0) AS l_quantity
    FROM tgt t FULL JOIN src s ON s.l_orderkey=t.l_orderkey AND s.l_linenumber=t.l_linenumber"""
)
def merge_accumulate(load):
    lines = load("lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    target = lines.groupBy(*keys).agg(F.sum("l_quantity").alias("l_quantity"))
    source = target.withColumn("l_orderkey", F.col("l_orderkey") + 1000)
    return (
        Merge(target, source, keys)
        .when_matched_update({"l_quantity": lambda t, s: t("l_quantity") + s("l_quantity")})
        .when_not_matched_insert()
        .result(unique=True)
    )


@query(
    """WITH src AS (SELECT c_custkey+750 AS k, CASE c_mktsegment WHEN 'BUILDING' THEN 'Terminated'
    WHEN 'MACHINERY' THEN 'Active' ELSE 'Inactive' END AS status FROM customer)
    SELECT coalesce(t.c_custkey,s.k) AS id, t.c_name AS name, s.status
    FROM customer t FULL JOIN src s ON s.k=t.c_custkey WHERE coalesce(s.status,'')<>'Terminated'"""
)
def merge_delete(load):
    customers = load("customer")
    target = customers.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(None).cast("string").alias("status")
    )
    segment = F.col("c_mktsegment")
    status = F.when(segment == "BUILDING", "Terminated").when(segment == "MACHINERY", "Active").otherwise("Inactive")
    source = customers.select((F.col("c_custkey") + 750).alias("id"), status.alias("status"))
    return (
        Merge(target, source, "id")
        .when_matched_delete(lambda t, s: s("status") == "Terminated")
        .when_matched_update({"status": "status"})
        .when_not_matched_insert({"id": "id", "status": "status"}, when=lambda t, s: s("status") != "Terminated")
        .result()
    )


@query(
    """WITH tgt AS (SELECT p_partkey AS id, p_size AS qty, p_retailprice AS unit_cost, 0 AS update_count FROM part),
    src AS (SELECT p_partkey+100 AS id, p_size-25 AS chg, p_retailprice+1 AS unit_cost FROM part)
    SELECT coalesce(t.id,s.id) AS id, coalesce(t.qty,0)+coalesce(s.chg,0) AS qty,
    coalesce(s.unit_cost,t.unit_cost) AS unit_cost,
    CASE WHEN s.id IS NULL THEN t.update_count ELSE coalesce(t.update_count,0)+1 END AS update_count,
    CASE WHEN s.id IS NOT NULL THEN TIMESTAMP '2024-06-01' END AS updated_at
    FROM tgt t FULL JOIN src s ON s.id=t.id"""
)
def merge_expressions(load):
    as_of = F.lit("2024-06-01").cast("timestamp_ntz")
    parts = load("part")
    target = parts.select(
        F.col("p_partkey").alias("id"),
        F.col("p_size").alias("qty"),
        F.col("p_retailprice").alias("unit_cost"),
        F.lit(0).alias("update_count"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )
    source = parts.select(
        (F.col("p_partkey") + 100).alias("id"),
        (F.col("p_size") - 25).alias("chg"),
        (F.col("p_retailprice") + 1).alias("unit_cost"),
    )
    return (
        Merge(target, source, "id")
        .when_matched_update(
            {
                "qty": lambda t, s: t("qty") + s("chg"),
                "unit_cost": "unit_cost",
                "update_count": lambda t, s: t("update_count") + 1,
                "updated_at": as_of,
            }
        )
        .when_not_matched_insert(
            {"id": "id", "qty": "chg", "unit_cost": "unit_cost", "update_count": F.lit(1), "updated_at": as_of}
        )
        .result()
    )


@query(
    """WITH src AS (SELECT user_id, sum(CASE WHEN event_type='purchase' THEN 1 ELSE -1 END)::BIGINT AS net,
    count(*) AS n FROM events WHERE event_type IN ('purchase','error') GROUP BY user_id),
    tgt AS (SELECT c_custkey AS user_id, 100::BIGINT AS balance, 0::BIGINT AS n FROM customer)
    SELECT coalesce(t.user_id,s.user_id) AS user_id, coalesce(t.balance,0)+coalesce(s.net,0) AS balance,
    coalesce(t.n,0)+coalesce(s.n,0) AS n FROM tgt t FULL JOIN src s ON s.user_id=t.user_id"""
)
def merge_from_aggregate(load):
    sign = F.when(F.col("event_type") == "purchase", 1).otherwise(-1)
    source = (
        load("events")
        .filter(F.col("event_type").isin("purchase", "error"))
        .groupBy("user_id")
        .agg(F.sum(sign).alias("net"), F.count("*").alias("n"))
    )
    target = load("customer").select(
        F.col("c_custkey").alias("user_id"), F.lit(100).cast("bigint").alias("balance"), F.lit(0).cast("bigint").alias("n")
    )
    return (
        Merge(target, source, "user_id")
        .when_matched_update(
            {"balance": lambda t, s: t("balance") + s("net"), "n": lambda t, s: t("n") + s("n")}
        )
        .when_not_matched_insert({"user_id": "user_id", "balance": "net", "n": "n"})
        .result(check=False)
    )


@query(
    """WITH src AS (SELECT c_custkey AS k, c_acctbal+1 AS bal FROM customer WHERE c_mktsegment<>'BUILDING')
    SELECT t.c_custkey, s.bal AS c_acctbal FROM customer t JOIN src s ON s.k=t.c_custkey"""
)
def merge_not_matched_by_source(load):
    customers = load("customer")
    source = customers.filter("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("k"), (F.col("c_acctbal") + 1).alias("bal")
    )
    return (
        Merge(customers.select("c_custkey", "c_acctbal"), source, {"c_custkey": "k"})
        .when_matched_update({"c_acctbal": "bal"})
        .when_not_matched_by_source_delete()
        .result()
    )


@query(
    """WITH src AS (SELECT CASE WHEN o_orderstatus='P' THEN NULL ELSE o_custkey END AS k FROM orders)
    SELECT k, count(*) AS n FROM src GROUP BY k HAVING count(*)>1 OR k IS NULL"""
)
def merge_source_checks(load):
    source = load("orders").select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))
    return source_checks(source, ["k"])


@query(
    """SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE NOT (o_totalprice<400000)
    OR NOT (o_orderstatus<>'P')"""
)
def constraint_violations(load):
    rules = {"price": "o_totalprice < 400000", "settled": "o_orderstatus <> 'P'"}
    rows = load("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return rows.filter(F.size(violations(rules)) > 0)


def _customers_without_debt(load) -> SnapshotTable:
    """Version 0: all customers; version 1: those in debt deleted."""
    table = SnapshotTable(load.spark, scratch_path(load.spark, "customer"))
    table.publish(load("customer"), "load")
    delete_where(table.read(), F.col("c_acctbal") < 0).apply(table, dry_run=False)
    return table


@query(
    """SELECT (SELECT count(*) FROM customer) AS previous_rows,
    (SELECT count(*) FROM customer WHERE c_acctbal>=0) AS current_rows,
    (SELECT count(*) FROM customer WHERE c_acctbal<0) AS diff"""
)
def snapshot_count_diff(load):
    return _customers_without_debt(load).count_diff(0)


@query("SELECT *, 'removed' AS change FROM customer WHERE c_acctbal<0")
def snapshot_diff(load):
    return _customers_without_debt(load).diff(0)


@query("SELECT * FROM customer")
def snapshot_restore(load):
    table = _customers_without_debt(load)
    table.restore(0)
    return table.read()


@query("SELECT * FROM orders")
def snapshot_compact(load):
    table = SnapshotTable(load.spark, scratch_path(load.spark, "orders"))
    table.publish(load("orders"), "load", partition_by=["o_orderpriority"])
    table.compact(2)
    return table.read().select(*load("orders").columns)


@query("SELECT * FROM orders WHERE o_totalprice>=250000")
def snapshot_cluster(load):
    """Sorted over files by price, so the filter skips files and row groups."""
    table = SnapshotTable(load.spark, scratch_path(load.spark, "orders"))
    table.publish(load("orders"), "load")
    table.cluster_by(["o_totalprice", "o_orderkey"], 4)
    return table.read().filter("o_totalprice >= 250000")


@query(
    """SELECT * FROM orders o WHERE NOT (o_orderpriority IN ('1-URGENT','2-HIGH') AND EXISTS
    (SELECT 1 FROM customer c WHERE c.c_custkey=o.o_custkey AND c.c_acctbal<0))"""
)
def delete_in_partitions(load):
    """Only the two partitions that hold victims are written again."""
    folder = scratch_path(load.spark, "by-priority")
    write_parquet(load("orders"), folder, partition_by=["o_orderpriority"])
    indebted = load("customer").filter("c_acctbal < 0")
    delete_in_place(
        load.spark,
        folder,
        ["o_orderpriority"],
        lambda orders: delete_scoped(
            orders, indebted, {"o_custkey": "c_custkey"}, F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        ),
        dry_run=False,
    )
    return load.spark.read.parquet(folder).select(*load("orders").columns)


def _priced(load, name: str) -> str:
    folder = scratch_path(load.spark, name)
    write_parquet(load("orders"), folder, partition_by=["o_orderpriority"])
    return folder


@query(
    """SELECT * FROM orders WHERE o_totalprice < (SELECT quantile_disc(o_totalprice, 0.9) FROM orders)"""
)
def delete_in_partitions_percentile(load):
    """The percentile is that of the whole table, whichever partitions hold its victims."""
    folder = _priced(load, "by-percentile")
    delete_in_place(
        load.spark, folder, ["o_orderpriority"], lambda t: delete_above_percentile(t, "o_totalprice", 0.9), dry_run=False
    )
    return load.spark.read.parquet(folder).select(*load("orders").columns)


@query(
    """SELECT * FROM orders WHERE o_custkey NOT IN
    (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING avg(o_totalprice)>300000)"""
)
def delete_in_partitions_groups(load):
    """Customers are judged over all partitions."""
    folder = _priced(load, "by-average")
    having = F.avg("o_totalprice") > 300_000
    delete_in_place(load.spark, folder, ["o_orderpriority"], lambda t: delete_groups(t, ["o_custkey"], having), dry_run=False)
    return load.spark.read.parquet(folder).select(*load("orders").columns)


@query(
    """WITH src AS (SELECT l_orderkey+100 AS k, max(l_extendedprice) AS top FROM lineitem GROUP BY 1),
    tgt AS (SELECT o_orderkey AS k, o_totalprice AS top FROM orders)
    SELECT t.* FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.k=t.k) UNION ALL SELECT * FROM src"""
)
def merge_upsert_unique(load):
    """Upsert of a source reduced to one row per key; a repeated key would fail the job."""
    target = load("orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("top"))
    source = load("lineitem").groupBy((F.col("l_orderkey") + 100).alias("k")).agg(F.max("l_extendedprice").alias("top"))
    return upsert(target, source, "k")


@query(
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn=1"""
)
def stream_upsert(load):
    table = UpsertTable(load.spark, scratch_path(load.spark, "latest-events"), ["user_id"], ["ts", "event_id"], parts=8)
    stream = read_file_stream(load.spark, load.folder, load("events").schema, glob="events.parquet")
    upsert_stream(stream, table, scratch_path(load.spark, "stream-progress")).awaitTermination()
    return table.read().select("user_id", "event_id", "event_type", "value")


@query(
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn=1 AND event_type<>'error'"""
)
def stream_change_log(load):
    """The last event of a user decides; an error removes the user. The newest third of the events comes first, so all others are late."""
    folder = scratch_path(load.spark, "live-users")
    table = UpsertTable(load.spark, folder, ["user_id"], ["ts", "event_id"], lambda s: s("event_type") == "error", parts=8)
    _in_waves(load, lambda stream, progress: upsert_stream(stream, table, progress))
    return table.read().select("user_id", "event_id", "event_type", "value")


@query(
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn=1 AND event_type<>'error'"""
)
def stream_upsert_state(load):
    """The same by keyed state: a batch costs its own keys, and the batches are folded into one folder at the end."""
    log = KeyedLog(load.spark, scratch_path(load.spark, "live-users"), ["user_id"], ["ts", "event_id"], lambda s: s("event_type") == "error")
    _in_waves(load, log.start)
    log.fold()
    return log.read().select("user_id", "event_id", "event_type", "value")


def _in_waves(load, start) -> None:
    """The events as a stream in three waves, the newest third first; the query ends and starts again between them."""
    events = load("events")
    arrival, progress = scratch_path(load.spark, "arrival"), scratch_path(load.spark, "stream-progress")
    late = F.pmod(F.xxhash64("event_id"), F.lit(2))
    newest = events.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.66)).first()[0] or 0
    wave = F.when(F.unix_micros(F.col("ts").cast("timestamp")) > newest, 0).otherwise(1 + late)
    for number in range(3):
        events.filter(wave == number).write.mode("append").parquet(arrival)
        start(read_file_stream(load.spark, arrival, events.schema), progress).awaitTermination()


HISTORY = """WITH said AS (SELECT user_id, ts, event_type, event_type = 'error' AS gone FROM events),
    changed AS (SELECT * FROM (SELECT *, lag(CASE WHEN gone THEN 'gone' ELSE 'is ' || event_type END)
        OVER (PARTITION BY user_id ORDER BY ts) AS b FROM said)
        WHERE b IS DISTINCT FROM (CASE WHEN gone THEN 'gone' ELSE 'is ' || event_type END) AND NOT (b IS NULL AND gone))
    SELECT user_id, event_type, valid_from, valid_to, valid_to IS NULL AS is_current FROM
        (SELECT *, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to FROM changed) WHERE NOT gone"""


@query(HISTORY)
def history_of_users(load):
    """What each user's last event was, from when to when; an error ends it."""
    gone = F.col("event_type") == "error"
    return history.steady(history.history_of(load("events"), ["user_id"], "ts", ["event_type"], gone), ["user_id"], ["event_type"])


@query(HISTORY)
def history_late_changes(load):
    """The same history from two batches, of which the second falls between the rows of the first."""
    events, gone = load("events"), F.col("event_type") == "error"
    first = history.history_of(events.filter("event_id % 3 <> 0"), ["user_id"], "ts", ["event_type"], gone)
    whole = history.apply_changes(first, events.filter("event_id % 3 = 0"), ["user_id"], "ts", ["event_type"], gone)
    return history.steady(whole, ["user_id"], ["event_type"])
