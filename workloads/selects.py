"""Selection of rows by criteria tables."""

from pyspark.sql import functions as F

from tablekeeper.operators import select
from tablekeeper.plans.grams import contains_join
from tablekeeper.plans.ranges import range_join
from tablekeeper.sources.files import literal_rows
from workloads.registry import query


def values(load, schema, rows):
    return literal_rows(load.spark, schema, rows)


@query(
    """WITH s(v) AS (VALUES ('BUILDING'),('MACHINERY'),('BUILDING'),(NULL))
    SELECT s.v AS search_value, c.* FROM s JOIN customer c ON c.c_mktsegment=s.v"""
)
def select_by_value(load):
    wanted = values(load, "segment string", [("BUILDING",), ("MACHINERY",), ("BUILDING",), (None,)])
    return select.select_by_value(load("customer"), wanted, "c_mktsegment", "segment")


@query(
    """WITH s(p,st) AS (SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders WHERE o_totalprice<1500)
    SELECT s.p AS search_priority, s.st AS search_status, o.* FROM s
    JOIN orders o ON o.o_orderpriority=s.p AND o.o_orderstatus=s.st"""
)
def select_by_columns(load):
    orders = load("orders")
    wanted = orders.filter("o_totalprice < 1500").select("o_orderpriority", "o_orderstatus").distinct()
    return select.select_by_columns(
        orders, wanted, ["o_orderpriority", "o_orderstatus"], ["search_priority", "search_status"]
    )


@query(
    """WITH s(lo,hi) AS (VALUES (1000e0,2000e0),(1500e0,3000e0))
    SELECT s.lo AS min_value, s.hi AS max_value, c.c_custkey, c.c_acctbal FROM s
    JOIN customer c ON c.c_acctbal>=s.lo AND c.c_acctbal<=s.hi"""
)
def select_between(load):
    ranges = values(load, "min_value double, max_value double", [(1000.0, 2000.0), (1500.0, 3000.0)])
    customers = load("customer").select("c_custkey", "c_acctbal")
    return select.select_between(customers, ranges, "c_acctbal", "min_value", "max_value")


@query(
    """SELECT p.p_retailprice AS low_price, p.p_retailprice+p.p_size AS high_price, l.l_orderkey, l.l_extendedprice
    FROM part p JOIN lineitem l ON l.l_extendedprice>=p.p_retailprice AND l.l_extendedprice<=p.p_retailprice+p.p_size"""
)
def select_between_grid(load):
    """A range per part: too many to broadcast, so the range join places both sides on a grid."""
    ranges = load("part").select(
        F.col("p_retailprice").alias("low_price"), (F.col("p_retailprice") + F.col("p_size")).alias("high_price")
    )
    lines = load("lineitem").select("l_orderkey", "l_extendedprice")
    return select.select_between(lines, ranges, "l_extendedprice", "low_price", "high_price")


@query(
    """WITH s(t) AS (VALUES (9000e0),(9500e0)) SELECT s.t AS threshold, c.c_custkey FROM s
    JOIN customer c ON c.c_acctbal>s.t"""
)
def select_greater(load):
    limits = values(load, "threshold double", [(9000.0,), (9500.0,)])
    found = select.select_greater(load("customer").select("c_custkey", "c_acctbal"), limits, "c_acctbal", "threshold")
    return found.select("threshold", "c_custkey")


@query(
    """WITH s(t) AS (VALUES (0e0),(-500e0)) SELECT s.t AS threshold, c.c_custkey FROM s
    JOIN customer c ON c.c_acctbal<s.t"""
)
def select_less(load):
    limits = values(load, "threshold double", [(0.0,), (-500.0,)])
    found = select.select_less(load("customer").select("c_custkey", "c_acctbal"), limits, "c_acctbal", "threshold")
    return found.select("threshold", "c_custkey")


@query("SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment='BUILDING')")
def select_in_set(load):
    builders = load("customer").filter("c_mktsegment = 'BUILDING'")
    return select.select_in_set(load("orders"), builders, {"o_custkey": "c_custkey"})


@query(
    """SELECT o.o_custkey AS search_o_custkey, l.* FROM orders o JOIN customer l ON l.c_custkey=o.o_custkey
    WHERE o.o_totalprice>=499000"""
)
def select_small_criteria(load):
    """Criteria derived from a large table, broadcast only after their row count was checked."""
    large = load("orders").filter("o_totalprice >= 499000")
    return select.select_by_columns(load("customer"), large, {"c_custkey": "o_custkey"}, small=True)


@query("SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING','MACHINERY')")
def select_value_list(load):
    return select.select_values(load("customer"), "c_mktsegment", ["BUILDING", "MACHINERY", None])


@query(
    """SELECT o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment
    FROM customer c JOIN orders o ON o.o_custkey=c.c_custkey"""
)
def select_join(load):
    customers = load("customer").select("c_custkey", "c_name", "c_mktsegment")
    joined = select.select_join(
        load("orders").select("o_orderkey", "o_custkey", "o_totalprice"), customers, {"o_custkey": "c_custkey"}
    )
    return joined.select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query(
    """WITH s(seg,bal,nk) AS (VALUES ('BUILDING',1000e0,3),('MACHINERY',0e0,5))
    SELECT s.seg, c.c_custkey FROM s
    JOIN customer c ON c.c_mktsegment=s.seg AND c.c_acctbal>=s.bal AND c.c_nationkey=s.nk"""
)
def select_condition(load):
    wanted = values(load, "seg string, bal double, nk int", [("BUILDING", 1000.0, 3), ("MACHINERY", 0.0, 5)])
    found = select.select_by_condition(
        load("customer"),
        wanted,
        lambda s, t: (t("c_mktsegment") == s("seg")) & (t("c_acctbal") >= s("bal")) & (t("c_nationkey") == s("nk")),
        {"seg": "seg"},
    )
    return found.select("seg", "c_custkey")


@query(
    """WITH s(kind,val,lo,hi) AS (VALUES ('exact_match','BUILDING',NULL,NULL),('range',NULL,9000e0,9500e0),
    ('contains','99',NULL,NULL),('other','x',NULL,NULL))
    SELECT s.kind, c.c_custkey FROM s JOIN customer c ON (s.kind='exact_match' AND c.c_mktsegment=s.val)
    OR (s.kind='range' AND c.c_acctbal BETWEEN s.lo AND s.hi) OR (s.kind='contains' AND contains(c.c_name,s.val))"""
)
def select_dispatch(load):
    rules = [
        ("exact_match", "BUILDING", None, None),
        ("range", None, 9000.0, 9500.0),
        ("contains", "99", None, None),
        ("other", "x", None, None),
    ]
    return select.select_dispatch(
        load("customer"),
        values(load, "kind string, val string, lo double, hi double", rules),
        kind="kind",
        value="val",
        lower="lo",
        upper="hi",
        exact_column="c_mktsegment",
        range_column="c_acctbal",
        contains_column="c_name",
        columns=["c_custkey"],
    )


@query(
    """WITH s(a,b) AS (VALUES (TIMESTAMP '1996-01-01',TIMESTAMP '1996-03-31'),
    (TIMESTAMP '1997-04-01',TIMESTAMP '1997-06-30'))
    SELECT s.a AS start_date, s.b AS end_date, o.o_orderkey FROM s
    JOIN orders o ON o.o_orderdate>=s.a AND o.o_orderdate<=s.b"""
)
def select_time_range(load):
    periods = values(
        load, "a string, b string", [("1996-01-01", "1996-03-31"), ("1997-04-01", "1997-06-30")]
    ).select(F.col("a").cast("timestamp_ntz").alias("start_date"), F.col("b").cast("timestamp_ntz").alias("end_date"))
    orders = load("orders").select("o_orderkey", "o_orderdate")
    return select.select_time_range(orders, periods, "o_orderdate", "start_date", "end_date").drop("o_orderdate")


@query(
    """SELECT c_mktsegment, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey)
    AS rn FROM customer) WHERE rn<=10"""
)
def select_capped(load):
    customers = load("customer").select("c_mktsegment", "c_custkey")
    segments = customers.select("c_mktsegment")
    return select.select_capped(customers, segments, "c_mktsegment", "c_custkey", per_value=10)


@query(
    """SELECT c_custkey AS idx, 'null value' AS error FROM customer WHERE nullif(c_mktsegment,'FURNITURE') IS NULL"""
)
def select_errors(load):
    criteria = load("customer").select(F.col("c_custkey").alias("idx"), F.expr("nullif(c_mktsegment, 'FURNITURE')").alias("v"))
    _, errors = select.selection_errors(criteria, "v", "idx")
    return errors


@query(
    """WITH s(v) AS (VALUES ('BUILDING'),('MACHINERY'),('nosuch'))
    SELECT s.v AS search_value, count(*) AS matches FROM s JOIN customer c ON c.c_mktsegment=s.v GROUP BY s.v"""
)
def select_summary(load):
    wanted = values(load, "v string", [("BUILDING",), ("MACHINERY",), ("nosuch",)])
    return select.selection_summary(load("customer"), wanted, {"c_mktsegment": "v"})


@query(
    """SELECT count(*) AS total_matches, count(DISTINCT c.c_custkey) AS unique_search_values,
    'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS target_columns FROM customer c JOIN orders o ON o.o_custkey=c.c_custkey WHERE c.c_acctbal<0"""
)
def select_totals(load):
    indebted = load("customer").filter("c_acctbal < 0")
    totals = select.selection_totals(load("orders"), indebted, {"o_custkey": "c_custkey"})
    return totals.withColumn("target_columns", F.array_join("target_columns", ","))


@query(
    """SELECT c.c_mktsegment, round(avg(o.o_totalprice),2) AS avg_price, count(o.o_orderkey) AS n
    FROM customer c JOIN orders o ON o.o_custkey=c.c_custkey GROUP BY c.c_mktsegment"""
)
def select_join_agg(load):
    found = select.select_join_agg(
        load("orders"),
        load("customer"),
        {"o_custkey": "c_custkey"},
        by=["c_mktsegment"],
        average={"avg_price": "o_totalprice"},
        count={"n": "o_orderkey"},
    )
    return found.withColumn("avg_price", F.round("avg_price", 2))


@query(
    """SELECT p.p_partkey, EXISTS(SELECT 1 FROM lineitem l WHERE l.l_partkey=p.p_partkey AND l.l_returnflag='R')
    AS found FROM part p"""
)
def validate_exists(load):
    returned = load("lineitem").filter("l_returnflag = 'R'")
    return select.validate_exists(load("part").select("p_partkey"), returned, {"p_partkey": "l_partkey"})


@query(
    """WITH f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
    SELECT c.c_custkey, c.c_name, f.o_orderkey, f.o_totalprice FROM customer c
    JOIN f ON f.o_custkey=c.c_custkey AND f.rn=1"""
)
def enrich_first(load):
    return select.enrich_first(
        load("customer").select("c_custkey", "c_name"),
        load("orders"),
        {"c_custkey": "o_custkey"},
        ["o_orderkey", "o_totalprice"],
        order="o_orderkey",
    )


@query(
    """WITH s AS (SELECT user_id, min(ts) AS start_date, max(ts) AS end_date FROM events
    WHERE event_type='signup' GROUP BY user_id)
    SELECT s.user_id, s.start_date, s.end_date, e.event_type AS action, count(*) AS n,
    sum(count(*)) OVER (PARTITION BY s.user_id)::BIGINT AS total_actions
    FROM s JOIN events e ON e.user_id=s.user_id AND e.ts>=s.start_date AND e.ts<=s.end_date
    GROUP BY s.user_id, s.start_date, s.end_date, e.event_type"""
)
def audit_breakdown(load):
    events = load("events").select("event_id", "user_id", "ts", "event_type")
    signups = events.filter("event_type = 'signup'").groupBy("user_id")
    periods = signups.agg(F.min("ts").alias("start_date"), F.max("ts").alias("end_date"))
    return select.audit_breakdown(
        periods, events, "user_id", time="ts", start="start_date", end="end_date", action="event_type"
    )


@query("SELECT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def select_contains(load):
    """Which documents hold which benchmark passage."""
    docs = load("documents").select("doc_id", "text")
    return contains_join(docs, load("benchmark").withColumnRenamed("text", "term"), "text", "term").select("item_id", "doc_id")


@query(
    """WITH t AS (SELECT DISTINCT unnest(string_split(text, '. ')) AS sentence FROM benchmark WHERE text IS NOT NULL)
    SELECT t.sentence, count(*) AS documents FROM t JOIN documents d ON contains(d.text, t.sentence) GROUP BY t.sentence"""
)
def select_contains_sentences(load):
    """How many documents hold each sentence of the benchmark passages, by an automaton of all sentences."""
    docs = load("documents").select("doc_id", "text")
    sentences = load("benchmark").select(F.explode(F.split("text", r"\. ")).alias("sentence")).distinct()
    return contains_join(docs, sentences, "text", "sentence").groupBy("sentence").agg(F.count("*").alias("documents"))


@query(
    """WITH w AS (SELECT DISTINCT unnest(string_split(lower(n_name), ' ')) AS word FROM nation UNION
        SELECT DISTINCT p_type FROM part UNION SELECT DISTINCT left(c_name, 16) FROM customer)
    SELECT w.word, c.c_custkey FROM w JOIN customer c ON contains(c.c_name, w.word)"""
)
def select_contains_many(load):
    """Beginnings of customers' names among other terms, the way of more terms than an automaton takes."""
    terms = load("nation").select(F.explode(F.split(F.lower("n_name"), " ")).alias("word"))
    terms = terms.union(load("part").select("p_type")).union(load("customer").select(F.left("c_name", F.lit(16))))
    names = load("customer").select("c_custkey", "c_name")
    found = contains_join(names, terms.distinct(), "c_name", "word", compare_rows=0, automaton_terms=0)
    return found.select("word", "c_custkey")


@query(
    """SELECT p.p_partkey, l.l_orderkey, l.l_linenumber FROM part p JOIN lineitem l
    ON l.l_extendedprice>=p.p_retailprice AND l.l_extendedprice<=p.p_retailprice+p.p_size"""
)
def select_between_mixed_types(load):
    """Lower bounds as text and upper bounds as decimals against doubles, the way of many ranges."""
    upper = F.col("p_retailprice") + F.col("p_size")
    ranges = load("part").select(
        "p_partkey", F.col("p_retailprice").cast("string").alias("low"), upper.cast("decimal(38,14)").alias("high")
    )
    lines = load("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    found = range_join(lines, ranges, "l_extendedprice", "low", "high", compare_rows=0)
    return found.select("p_partkey", "l_orderkey", "l_linenumber")


@query(
    """WITH t AS (SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT -1, 1e30)
    SELECT p.p_partkey, t.o_orderkey FROM part p JOIN t ON t.o_totalprice>=p.p_retailprice AND t.o_totalprice<=p.p_retailprice+p.p_size"""
)
def select_between_outlier(load):
    """One extreme value must not put all others into one cell."""
    orders = load("orders").select("o_orderkey", "o_totalprice")
    lone = values(load, "o_orderkey bigint, o_totalprice double", [(-1, 1e30)])
    ranges = load("part").select("p_partkey", F.col("p_retailprice").alias("low"), (F.col("p_retailprice") + F.col("p_size")).alias("high"))
    found = range_join(orders.unionByName(lone), ranges, "o_totalprice", "low", "high", compare_rows=0)
    return found.select("p_partkey", "o_orderkey")


@query(
    """SELECT p.p_partkey AS part, l.l_orderkey, l.l_linenumber FROM part p JOIN lineitem l
    ON l.l_partkey=p.p_partkey AND l.l_quantity>p.p_size"""
)
def select_condition_large(load):
    """An equality and a range per part, with as many criteria as there are parts."""
    found = select.select_by_condition(
        load("lineitem"),
        load("part").select("p_partkey", "p_size"),
        lambda s, t: (t("l_partkey") == s("p_partkey")) & (t("l_quantity") > s("p_size")),
        {"p_partkey": "part"},
    )
    return found.select("part", "l_orderkey", "l_linenumber")


@query(
    """SELECT p.p_partkey AS part, l.l_orderkey, l.l_linenumber FROM part p JOIN lineitem l
    ON l.l_extendedprice < p.p_retailprice AND l.l_quantity > p.p_size + 30"""
)
def select_condition_inequalities(load):
    """Two comparisons of different columns and no equality."""
    found = select.select_by_condition(
        load("lineitem"),
        load("part").select("p_partkey", "p_retailprice", "p_size"),
        lambda s, t: (t("l_extendedprice") < s("p_retailprice")) & (t("l_quantity") > s("p_size") + 30),
        {"p_partkey": "part"},
    )
    return found.select("part", "l_orderkey", "l_linenumber")


@query(
    """SELECT p.p_partkey AS part, l.l_orderkey, l.l_linenumber FROM part p JOIN lineitem l
    ON l.l_extendedprice - 100 BETWEEN p.p_retailprice AND p.p_retailprice + p.p_size AND l.l_tax <> p.p_size / 100"""
)
def select_condition_range(load):
    """A range around an expression, beside a test that is no comparison of order."""
    found = select.select_by_condition(
        load("lineitem"),
        load("part").select("p_partkey", "p_retailprice", "p_size"),
        lambda s, t: (t("l_extendedprice") - 100).between(s("p_retailprice"), s("p_retailprice") + s("p_size"))
        & (t("l_tax") != s("p_size") / 100),
        {"p_partkey": "part"},
    )
    return found.select("part", "l_orderkey", "l_linenumber")


@query(
    """WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders),
    w AS (SELECT s_suppkey, strftime(DATE '1995-01-01' + (s_suppkey % 2400)::INT, '%Y-%m-%d') AS first,
        strftime(DATE '1995-01-03' + (s_suppkey % 2400)::INT, '%Y-%m-%d') AS last FROM supplier)
    SELECT w.s_suppkey, o.o_orderkey, o.day FROM w JOIN o ON o.day >= w.first AND o.day <= w.last"""
)
def select_between_text_days(load):
    """Windows of three days as ISO text, the way of many ranges."""
    orders = load("orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    days = F.col("s_suppkey").cast("int") % 2400
    first, last = (F.date_add(F.lit(d).cast("date"), days).cast("string") for d in ("1995-01-01", "1995-01-03"))
    windows = load("supplier").select("s_suppkey", first.alias("first"), last.alias("last"))
    return range_join(orders, windows, "day", "first", "last", compare_rows=0).select("s_suppkey", "o_orderkey", "day")


@query(
    """WITH h AS (SELECT DISTINCT regexp_extract(url, '^[a-z]+://[^/]+') AS site FROM pages)
    SELECT h.site, p.page_id FROM h JOIN pages p ON p.url >= h.site || '/' AND p.url < h.site || '0'"""
)
def select_between_urls(load):
    """The pages below each site, as ranges of addresses that begin alike."""
    pages = load("pages").select("page_id", "url")
    site = F.regexp_extract("url", "^[a-z]+://[^/]+", 0).alias("site")
    sites = pages.select(site).distinct().select("site", F.concat("site", F.lit("/")).alias("low"), F.concat("site", F.lit("0")).alias("high"))
    found = range_join(pages, sites, "url", "low", "high", compare_rows=0)
    return found.filter("url < high").select("site", "page_id")


@query(
    """WITH p AS (SELECT user_id, ts AS a, ts + INTERVAL 10 DAY AS b FROM events WHERE event_type IN ('signup', 'purchase'))
    SELECT p.user_id, p.a, p.b, e.event_type AS action, count(*) AS n,
    sum(count(*)) OVER (PARTITION BY p.user_id, p.a, p.b)::BIGINT AS total_actions
    FROM (SELECT DISTINCT * FROM p) p JOIN events e ON e.user_id=p.user_id AND e.ts BETWEEN p.a AND p.b
    GROUP BY p.user_id, p.a, p.b, e.event_type"""
)
def audit_overlapping_periods(load):
    """The ten days after every signup and purchase of a user: most periods overlap others."""
    events = load("events").select("event_id", "user_id", "ts", "event_type")
    starts = events.filter("event_type IN ('signup', 'purchase')")
    periods = starts.select("user_id", F.col("ts").alias("a"), (F.col("ts") + F.expr("INTERVAL 10 DAYS")).alias("b"))
    return select.audit_breakdown(periods, events, "user_id", time="ts", start="a", end="b", action="event_type")
