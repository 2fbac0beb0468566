"""Duplicates, missing values, positions, quantiles, outliers and samples."""

from pyspark.sql import functions as F

from tablekeeper.operators import clean
from workloads.registry import query

EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value"]


def _with_gaps(load):
    return load("customer").select(
        "c_custkey",
        F.expr("nullif(c_nationkey, 3)").alias("nk"),
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("seg"),
    )


@query(
    """WITH t AS (SELECT c_custkey, CASE WHEN c_mktsegment='FURNITURE' THEN NULL ELSE c_acctbal END AS bal
    FROM customer) SELECT * FROM t WHERE bal<=5000"""
)
def keep_where_null_dropped(load):
    balance = F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_acctbal"))
    return clean.keep_where(load("customer").select("c_custkey", balance.alias("bal")), F.col("bal") <= 5000)


@query("SELECT DISTINCT event_type, user_id FROM events")
def drop_duplicates_all(load):
    return clean.drop_duplicates(load("events").select("event_type", "user_id"))


@query(
    """SELECT event_id, user_id, event_type, value FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn=1"""
)
def drop_duplicates_first(load):
    return clean.drop_duplicates(
        load("events"), ["user_id", "event_type"], keep="first", order=["ts", "event_id"]
    ).select(*EVENT_COLUMNS)


@query(
    """SELECT event_id, user_id, event_type, value FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn=1"""
)
def drop_duplicates_last(load):
    return clean.drop_duplicates(
        load("events"), ["user_id", "event_type"], keep="last", order=["ts", "event_id"]
    ).select(*EVENT_COLUMNS)


@query(
    """SELECT l.* FROM lineitem l WHERE (l_orderkey, l_linenumber) IN
    (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*)=1)"""
)
def drop_duplicates_none(load):
    return clean.drop_duplicates(load("lineitem"), ["l_orderkey", "l_linenumber"], keep="none")


GAPS = """WITH t AS (SELECT c_custkey, nullif(c_nationkey,3) AS nk, nullif(c_mktsegment,'BUILDING') AS seg
FROM customer) """


@query(GAPS + "SELECT * FROM t WHERE nk IS NOT NULL AND seg IS NOT NULL")
def drop_missing_any(load):
    return clean.drop_missing(_with_gaps(load))


@query(GAPS + "SELECT nk, seg FROM t WHERE nk IS NOT NULL OR seg IS NOT NULL")
def drop_missing_all(load):
    return clean.drop_missing(_with_gaps(load).select("nk", "seg"), how="all")


@query(GAPS + "SELECT * FROM t WHERE nk IS NOT NULL")
def drop_missing_subset(load):
    return clean.drop_missing(_with_gaps(load), subset=["nk"])


@query(
    GAPS
    + """SELECT 'nk' AS column_name, count(*)-count(nk) AS missing FROM t
    UNION ALL SELECT 'seg', count(*)-count(seg) FROM t"""
)
def missing_counts(load):
    return clean.missing_counts(_with_gaps(load), ["nk", "seg"])


@query(
    GAPS
    + """SELECT 'nk' AS column_name, 'int' AS type, count(DISTINCT nk) AS distinct_values, count(*)-count(nk) AS missing FROM t
    UNION ALL SELECT 'seg', 'string', count(DISTINCT seg), count(*)-count(seg) FROM t"""
)
def profile_criteria(load):
    return clean.profile_criteria(_with_gaps(load), ["nk", "seg"])


@query(
    """SELECT 'o_custkey' AS column_name, 'bigint' AS type, count(*) AS rows, count(*)-count(o_custkey) AS missing,
    min(o_custkey)::VARCHAR AS minimum, max(o_custkey)::VARCHAR AS maximum, true AS distinct_is_near FROM orders
    UNION ALL SELECT 'o_orderpriority', 'string', count(*), count(*)-count(o_orderpriority), min(o_orderpriority),
    max(o_orderpriority), true FROM orders"""
)
def column_stats(load):
    stats = clean.column_stats(load("orders"), ["o_custkey", "o_orderpriority"])
    exact = load("orders").agg(F.countDistinct("o_custkey").alias("o_custkey"), F.countDistinct("o_orderpriority").alias("o_orderpriority"))
    exact = exact.unpivot([], ["o_custkey", "o_orderpriority"], "column_name", "exact")
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.2 * F.col("exact")
    return stats.join(exact, "column_name").select("column_name", "type", "rows", "missing", "minimum", "maximum", near.alias("distinct_is_near"))


@query(
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey)-1 AS rn FROM orders)
    WHERE rn NOT IN (0,2,4)"""
)
def delete_positions(load):
    return clean.delete_positions(load("orders"), "o_orderkey", [0, 2, 4], key="o_orderkey")


SPREAD = [3, 50, 90, 144, 233, 377, 400, 555, 610, 700, 801, 987, 1024, 1111, 1290, 1400]
BY_PRICE = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey)-1 AS rn
FROM orders) WHERE rn NOT IN """


@query(BY_PRICE + str(tuple(SPREAD)))
def delete_positions_spread(load):
    """Many positions, assigned partition by partition as in a table too large for a top-k."""
    return clean.delete_positions(
        load("orders"), ["-o_totalprice", "o_orderkey"], SPREAD, key="o_orderkey", top_rows=0
    )


@query(BY_PRICE + "(700,1400)")
def delete_positions_few(load):
    """A few far positions, each found by narrowing a bracket."""
    return clean.delete_positions(
        load("orders"), ["-o_totalprice", "o_orderkey"], [700, 1400], key="o_orderkey", top_rows=0, rest_rows=500
    )


@query(
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey)-1 AS rn FROM orders)
    WHERE NOT (rn>=2 AND rn<5)"""
)
def delete_position_range(load):
    return clean.delete_position_range(load("orders"), "o_orderkey", 2, 5)


@query("SELECT * FROM orders WHERE o_totalprice <= (SELECT quantile_cont(o_totalprice,0.8) FROM orders)")
def drop_top_fraction(load):
    return clean.drop_top_fraction(load("orders"), "o_totalprice", 0.2)


@query("SELECT * FROM orders WHERE o_totalprice > (SELECT quantile_cont(o_totalprice,0.2) FROM orders)")
def drop_bottom_fraction(load):
    return clean.drop_bottom_fraction(load("orders"), "o_totalprice", 0.2)


@query(
    """SELECT doc_id, n_chars FROM documents
    WHERE n_chars <= (SELECT avg(n_chars)+2*stddev_samp(n_chars) FROM documents)"""
)
def drop_outliers_upper(load):
    return clean.drop_outliers(load("documents").select("doc_id", "n_chars"), "n_chars", sides="upper")


@query(
    """SELECT doc_id, n_chars FROM documents WHERE abs(n_chars-(SELECT avg(n_chars) FROM documents))
    <= 2*(SELECT stddev_samp(n_chars) FROM documents)"""
)
def drop_outliers_both(load):
    return clean.drop_outliers(load("documents").select("doc_id", "n_chars"), "n_chars", sides="both")


@query(
    """SELECT * EXCLUDE (rn,n) FROM (SELECT *, row_number() OVER
    (ORDER BY md5(o_orderkey::VARCHAR||':42'), o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
    WHERE rn<=round_even(0.7*n,0)"""
)
def sample_exact_fraction(load):
    return clean.sample_exact(load("orders"), "o_orderkey", 0.7, seed=42, method="md5")


@query(
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn
    FROM orders) WHERE rn>3"""
)
def delete_top_n(load):
    return clean.delete_top_n(load("orders"), "o_totalprice", 3, tie_order="o_orderkey")


@query(
    """SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey::VARCHAR) DESC, o_orderkey) AS rn
    FROM orders) WHERE rn>50"""
)
def delete_top_n_binary(load):
    """The largest values of a binary column."""
    orders = load("orders").select("o_orderkey", F.unhex(F.md5(F.col("o_orderkey").cast("string"))).alias("digest"))
    return clean.delete_top_n(orders, "digest", 50, "o_orderkey", top_rows=0).select("o_orderkey")
