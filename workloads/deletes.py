"""Deletes by criteria tables, predicates and analysis."""

from pyspark.sql import functions as F

from tablekeeper.operators import delete
from workloads.registry import query
from workloads.selects import values


@query(
    """SELECT * FROM orders o WHERE NOT EXISTS
    (SELECT 1 FROM lineitem l WHERE l.l_orderkey=o.o_orderkey AND l.l_returnflag='R')"""
)
def delete_by_ids(load):
    returned = load("lineitem").filter("l_returnflag = 'R'")
    return delete.delete_by_keys(load("orders"), returned, {"o_orderkey": "l_orderkey"}).kept()


@query("SELECT * FROM customer WHERE c_mktsegment NOT IN ('BUILDING','MACHINERY')")
def delete_by_values(load):
    return delete.delete_by_values(load("customer"), "c_mktsegment", ["BUILDING", "MACHINERY"]).kept()


@query(
    """WITH k AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_quantity>=49)
    SELECT l.* FROM lineitem l LEFT JOIN k ON k.l_partkey=l.l_partkey AND k.l_suppkey=l.l_suppkey
    WHERE k.l_partkey IS NULL"""
)
def delete_by_columns(load):
    lines = load("lineitem")
    return delete.delete_by_keys(lines, lines.filter("l_quantity >= 49"), ["l_partkey", "l_suppkey"]).kept()


@query(
    """WITH k(seg,bal) AS (VALUES ('BUILDING',5000e0),('MACHINERY',8000e0),('FURNITURE',NULL))
    SELECT * FROM customer c WHERE NOT EXISTS
    (SELECT 1 FROM k WHERE k.seg=c.c_mktsegment AND (k.bal IS NULL OR c.c_acctbal>=k.bal))"""
)
def delete_by_thresholds(load):
    limits = values(
        load, "seg string, bal double", [("BUILDING", 5000.0), ("MACHINERY", 8000.0), ("FURNITURE", None)]
    )
    return delete.delete_by_thresholds(load("customer"), limits, {"c_mktsegment": "seg"}, "c_acctbal", "bal").kept()


@query(
    """SELECT * FROM orders o WHERE NOT EXISTS
    (SELECT 1 FROM customer c WHERE c.c_custkey=o.o_custkey AND o.o_totalprice>=c.c_acctbal*20)"""
)
def delete_by_join_condition(load):
    condition = "t.o_custkey = c.c_custkey AND t.o_totalprice >= c.c_acctbal * 20"
    return delete.delete_by_condition(load("orders"), load("customer"), condition, ["o_orderkey"]).kept()


@query("SELECT * FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal<0)")
def delete_by_subquery(load):
    return delete.delete_by_query(
        load("customer"),
        "SELECT s_nationkey FROM {suppliers} WHERE s_acctbal < 0",
        {"c_nationkey": "s_nationkey"},
        suppliers=load("supplier"),
    ).kept()


def _orders_of_indebted(load):
    indebted = load("customer").filter("c_acctbal < 0")
    return delete.delete_by_keys(load("orders"), indebted, {"o_custkey": "c_custkey"})


@query(
    """SELECT o.* FROM orders o WHERE EXISTS
    (SELECT 1 FROM customer c WHERE c.c_custkey=o.o_custkey AND c.c_acctbal<0)"""
)
def delete_preview(load):
    return _orders_of_indebted(load).preview()


@query(
    """WITH d AS (SELECT o.*, EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey=o.o_custkey AND c.c_acctbal<0) AS hit
    FROM orders o)
    SELECT count(*) AS rows_before, count(*) FILTER (WHERE hit) AS rows_deleted,
    count(*) FILTER (WHERE NOT hit) AS rows_after,
    round(100.0*count(*) FILTER (WHERE hit)/count(*),1)::DOUBLE AS pct_deleted FROM d"""
)
def delete_report(load):
    return _orders_of_indebted(load).report()


@query(
    """SELECT o.*, c.c_mktsegment AS reason FROM orders o
    JOIN customer c ON c.c_custkey=o.o_custkey AND c.c_acctbal<0"""
)
def delete_reasons(load):
    indebted = load("customer").filter("c_acctbal < 0").withColumnRenamed("c_mktsegment", "reason")
    return delete.explain_by_keys(load("orders"), indebted, {"o_custkey": "c_custkey"}, ["reason"])


@query("SELECT * FROM orders WHERE NOT coalesce(o_orderstatus='F' AND o_totalprice>70000,false)")
def delete_query_string(load):
    return delete.delete_query(load("orders"), "o_orderstatus = 'F' AND o_totalprice > 70000").kept()


@query(
    """WITH t AS (SELECT c_custkey, CASE WHEN c_mktsegment='FURNITURE' THEN NULL ELSE c_acctbal END AS bal
    FROM customer) SELECT * FROM t WHERE NOT coalesce(bal>5000,false)"""
)
def delete_where_null_kept(load):
    balance = F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_acctbal"))
    rows = load("customer").select("c_custkey", balance.alias("bal"))
    return delete.delete_where(rows, F.col("bal") > 5000).kept()


@query("SELECT * FROM part WHERE NOT coalesce(contains(lower(p_name),'re'),false)")
def delete_text_match(load):
    return delete.delete_text_match(load("part"), "p_name", "RE").kept()


@query(
    """SELECT * FROM orders o WHERE NOT (EXISTS
    (SELECT 1 FROM customer c WHERE c.c_custkey=o.o_custkey AND c.c_mktsegment='BUILDING')
    AND coalesce(o.o_orderstatus='F',false))"""
)
def delete_scoped(load):
    builders = load("customer").filter("c_mktsegment = 'BUILDING'")
    return delete.delete_scoped(load("orders"), builders, {"o_custkey": "c_custkey"}, "o_orderstatus = 'F'").kept()


@query("SELECT * FROM orders WHERE NOT o_totalprice >= (SELECT quantile_disc(o_totalprice,0.75) FROM orders)")
def delete_above_percentile(load):
    return delete.delete_above_percentile(load("orders"), "o_totalprice", 0.75).kept()


@query(
    """SELECT * FROM customer WHERE c_nationkey NOT IN
    (SELECT c_nationkey FROM customer GROUP BY c_nationkey HAVING avg(c_acctbal)>4500)"""
)
def delete_groups_by_avg(load):
    return delete.delete_groups(load("customer"), ["c_nationkey"], F.avg("c_acctbal") > 4500).kept()


@query(
    """WITH r(kind,days) AS (VALUES ('view',5),('error',1)) SELECT e.* FROM events e WHERE NOT EXISTS
    (SELECT 1 FROM r WHERE r.kind=e.event_type AND e.ts < (SELECT max(ts) FROM events) - to_days(r.days))"""
)
def delete_retention(load):
    events = load("events")
    newest = events.agg(F.max("ts").cast("string")).first()[0]
    rules = values(load, "kind string, days int", [("view", 5), ("error", 1), ("view", 9)])
    return delete.delete_retention(
        events, rules, kind={"event_type": "kind"}, time="ts", days="days",
        as_of=F.lit(newest).cast("timestamp_ntz"),
    ).kept()


@query(
    """WITH t AS (SELECT c_custkey, c_acctbal, nullif(c_mktsegment,'BUILDING') AS seg FROM customer)
    SELECT * FROM t WHERE NOT coalesce(seg IS NULL,false) AND NOT coalesce(c_acctbal<0,false)
    AND NOT coalesce(seg='MACHINERY',false)"""
)
def delete_quality_rules(load):
    rows = load("customer").select("c_custkey", "c_acctbal", F.expr("nullif(c_mktsegment, 'BUILDING')").alias("seg"))
    rules = [("seg", "is_null"), ("c_acctbal", "negative"), ("seg", "unknown", "MACHINERY")]
    return delete.delete_quality(rows, rules).kept()


@query("SELECT c_custkey, c_name, NOT coalesce(c_acctbal<0,false) AS active FROM customer")
def soft_delete(load):
    rows = load("customer").select("c_custkey", "c_name", "c_acctbal")
    return delete.soft_delete(rows, F.col("c_acctbal") < 0).drop("c_acctbal")


@query(
    """WITH t AS (SELECT p_partkey, 'a/b/'||p_name||'-'||p_partkey::VARCHAR||'.pdf' AS file_name FROM part),
    l AS (SELECT 'box/'||p_name||'-'||p_partkey::VARCHAR||'.pdf' AS path FROM part WHERE p_size<10)
    SELECT t.* FROM t WHERE regexp_extract(t.file_name,'[^/]*$') NOT IN
    (SELECT regexp_extract(path,'[^/]*$') FROM l WHERE regexp_extract(path,'[^/]*$')<>'')"""
)
def inventory_delete_matches(load):
    name = F.concat(F.col("p_name"), F.lit("-"), F.col("p_partkey").cast("string"), F.lit(".pdf"))
    catalogue = load("part").select("p_partkey", F.concat(F.lit("a/b/"), name).alias("file_name"))
    listing = load("part").filter("p_size < 10").select(F.concat(F.lit("box/"), name).alias("name"))
    return delete.delete_base_names(catalogue, listing, "file_name").kept()


@query(
    """SELECT l.* FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o JOIN customer c ON c.c_custkey=o.o_custkey
    WHERE c.c_acctbal<0 AND o.o_orderkey=l.l_orderkey)"""
)
def delete_cascade(load):
    tables = {name: load(name) for name in ("customer", "orders", "lineitem")}
    links = [
        ("customer", "orders", {"o_custkey": "c_custkey"}),
        ("orders", "lineitem", {"l_orderkey": "o_orderkey"}),
    ]
    root = delete.delete_where(tables["customer"], F.col("c_acctbal") < 0)
    return delete.delete_cascade(tables, links, "customer", root)["lineitem"].kept()


@query("SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal<0)")
def delete_by_value_table(load):
    """The values come from a column of another table."""
    indebted = load("customer").filter("c_acctbal < 0")
    return delete.delete_by_values(load("orders"), "o_custkey", indebted, "c_custkey").kept()


@query(
    """SELECT o_orderkey, o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal<0) AS active FROM orders"""
)
def soft_delete_by_keys(load):
    indebted = load("customer").filter("c_acctbal < 0")
    orders = load("orders").select("o_orderkey", "o_custkey")
    return delete.soft_delete_by_keys(orders, indebted, {"o_custkey": "c_custkey"}).select("o_orderkey", "active")


@query(
    """SELECT * FROM lineitem l WHERE NOT EXISTS
    (SELECT 1 FROM part p WHERE p.p_partkey=l.l_partkey AND l.l_quantity>p.p_size)"""
)
def delete_condition_large(load):
    """An equality and a range per part, with as many criteria as there are parts."""
    condition = "t.l_partkey = c.p_partkey AND t.l_quantity > c.p_size"
    return delete.delete_by_condition(load("lineitem"), load("part"), condition, ["l_orderkey", "l_linenumber"]).kept()


@query(
    """WITH w AS (SELECT o_orderkey, o_orderkey+9007199254740992 AS wide FROM orders)
    SELECT o_orderkey FROM w WHERE wide < (SELECT quantile_disc(wide, 0.75) FROM w)"""
)
def delete_percentile_wide(load):
    """Whole numbers that a double cannot tell apart."""
    orders = load("orders").select("o_orderkey", (F.col("o_orderkey") + 2**53).alias("wide"))
    return delete.delete_above_percentile(orders, "wide", 0.75).kept().select("o_orderkey")


@query("SELECT true AS within, count(*) AS rows_before FROM orders")
def delete_percentile_approximate(load):
    """With an accuracy the cut's rank is off by at most 1 in that many rows, and the row at the cut goes too."""
    plan = delete.delete_above_percentile(load("orders"), "o_totalprice", 0.9, accuracy=1000)
    off = F.abs(F.col("rows_after") - 0.9 * F.col("rows_before"))
    return plan.report().select((off <= F.col("rows_before") / 1000 + 1).alias("within"), "rows_before")


@query(
    """SELECT l_orderkey, l_linenumber FROM lineitem l WHERE NOT EXISTS
    (SELECT 1 FROM part p WHERE l.l_extendedprice < p.p_retailprice + 9000 AND l.l_quantity > p.p_size + 20)"""
)
def delete_condition_staircase(load):
    """Two comparisons and no equality: the best parts decide, and no pair is formed."""
    condition = "t.l_extendedprice < c.p_retailprice + 9000 AND t.l_quantity > c.p_size + 20"
    plan = delete.delete_by_condition(load("lineitem"), load("part"), condition, ["l_orderkey", "l_linenumber"])
    return plan.kept().select("l_orderkey", "l_linenumber")


@query(
    """SELECT l_orderkey, l_linenumber FROM lineitem l WHERE EXISTS (SELECT 1 FROM part p
    WHERE l.l_extendedprice < p.p_retailprice + 50 AND l.l_quantity > p.p_size + 30 AND l.l_partkey > p.p_partkey)"""
)
def delete_condition_grid(load):
    """Three comparisons of different columns: the rows that would go."""
    condition = "t.l_extendedprice < c.p_retailprice + 50 AND t.l_quantity > c.p_size + 30 AND t.l_partkey > c.p_partkey"
    plan = delete.delete_by_condition(load("lineitem"), load("part"), condition, ["l_orderkey", "l_linenumber"])
    return plan.preview().select("l_orderkey", "l_linenumber")


@query(
    """WITH RECURSIVE o AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey >= 3 THEN o_orderkey // 3 END AS parent, o_totalprice FROM orders),
    gone(id) AS (SELECT id FROM o WHERE o_totalprice > 450000 UNION SELECT o.id FROM o JOIN gone ON o.parent = gone.id)
    SELECT o.id, o.parent FROM o WHERE o.id NOT IN (SELECT id FROM gone)"""
)
def delete_closure_tree(load):
    """Orders as a tree of many levels: what hangs below the dearest goes with them."""
    key = F.col("o_orderkey")
    orders = load("orders").select(key.alias("id"), F.when(key >= 3, F.floor(key / 3)).alias("parent"), "o_totalprice")
    plan = delete.delete_where(orders, F.col("o_totalprice") > 450000)
    plans = delete.delete_closure({"orders": orders}, [("orders", "orders", {"parent": "id"})], "orders", plan)
    return plans["orders"].kept().select("id", "parent")
