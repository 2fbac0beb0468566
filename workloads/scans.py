"""Sources, views, unions and listings."""

import uuid

from pyspark.sql import functions as F

from tablekeeper.functions import paths, predicates
from tablekeeper.operators import clean, sketches
from tablekeeper.plans.curve import write_clustered
from tablekeeper.plans.digests import table_diff
from tablekeeper.plans.ranks import By
from tablekeeper.session import scratch_path
from tablekeeper.sources import files, listing
from workloads.registry import query


@query("SELECT * FROM orders")
def scan_parquet_view(load):
    files.read_parquet(load.spark, load.path("orders"), view="orders_view")
    return files.query_view(load.spark, "orders_view")


@query("SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus IN ('F','O')")
def scan_multi_path(load):
    """A path and a glob over two folders in one read."""
    root, orders = scratch_path(load.spark, "by-status"), load("orders")
    for status in ("F", "O"):
        orders.filter(F.col("o_orderstatus") == status).write.parquet(f"{root}/status-{status}")
    return files.read_parquet(load.spark, [load.path("orders"), f"{root}/status-*"], view="all_orders")


@query(
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus='F' THEN o_totalprice END AS o_totalprice
    FROM orders"""
)
def scan_merge_schema(load):
    root = scratch_path(load.spark, "evolved")
    orders, finished = load("orders"), F.col("o_orderstatus") == "F"
    orders.filter(~finished).select("o_orderkey", "o_custkey").write.parquet(f"{root}/old")
    orders.filter(finished).select("o_orderkey", "o_custkey", "o_totalprice").write.parquet(f"{root}/new")
    merged = files.read_parquet(
        load.spark, [f"{root}/old", f"{root}/new"], mergeSchema=True, pathGlobFilter="*.parquet"
    )
    return merged.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    """SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice),2) AS avg_price,
    max(o_totalprice) AS max_price, min(o_totalprice) AS min_price FROM orders GROUP BY o_orderpriority"""
)
def view_group_summary(load):
    files.read_parquet(load.spark, load.path("orders"), view="priced_orders")
    return (
        files.query_view(load.spark, "priced_orders")
        .groupBy("o_orderpriority")
        .agg(
            F.count("*").alias("n"),
            F.round(F.avg("o_totalprice"), 2).alias("avg_price"),
            F.max("o_totalprice").alias("max_price"),
            F.min("o_totalprice").alias("min_price"),
        )
        .orderBy(F.col("avg_price").desc(), "o_orderpriority")
    )


@query(
    """SELECT (SELECT count(*) FROM events) AS row_count,
    (SELECT count(*) FROM (SELECT DISTINCT event_type, user_id FROM events)) AS distinct_rows"""
)
def view_row_counts(load):
    return clean.table_counts(load("events"), ["event_type", "user_id"])


@query("SELECT DISTINCT p_name FROM part")
def distinct_names(load):
    return files.distinct_sorted(load("part"), "p_name")


@query("SELECT event_id, CAST(json_extract_string(props,'$.k') AS BIGINT) AS k FROM events")
def parse_json_props(load):
    parsed = load("events").select("event_id", files.parse_json(F.col("props"), "k bigint").alias("props"))
    return files.flatten(parsed).withColumnRenamed("props_k", "k")


@query(
    """SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS acctbal, 'customer' AS origin FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier"""
)
def flatten_union(load):
    customers = load("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    suppliers = load("supplier").select("s_suppkey", "s_name", "s_acctbal").toDF("id", "name", "acctbal")
    both = files.union_all_by_name([customers, suppliers], [{"origin": "customer"}, {"origin": "supplier"}])
    return both.select("id", "name", "acctbal", "origin")


@query("SELECT o_orderpriority, o_orderstatus, o_orderkey, o_totalprice FROM orders")
def partitioned_write(load):
    folder = scratch_path(load.spark, "partitioned")
    rows = load("orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    files.write_parquet(rows, folder, partition_by=["o_orderpriority"])
    return files.read_parquet(load.spark, folder).select(
        "o_orderpriority", "o_orderstatus", "o_orderkey", "o_totalprice"
    )


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE NOT c_acctbal<0")
def csv_filter(load):
    folder = scratch_path(load.spark, "csv")
    customers = load("customer")
    customers.write.option("header", True).csv(folder)
    return files.read_csv(load.spark, folder, customers.schema).filter("NOT c_acctbal < 0")


@query(
    r"""SELECT page_id, regexp_extract(regexp_replace(split_part(split_part(url,'?',1),'#',1),'\\','/','g'),'[^/]*$')
    AS base_name FROM pages"""
)
def path_basename(load):
    return load("pages").select("page_id", paths.base_name(paths.url_path(F.col("url"))).alias("base_name"))


@query(
    """SELECT page_id, split_part(p,'/',1) AS container,
    CASE WHEN contains(p,'/') THEN substr(p, instr(p,'/')+1) ELSE '' END AS prefix
    FROM (SELECT page_id, regexp_replace(url,'^[a-z]+://','') AS p FROM pages)"""
)
def split_container_prefix(load):
    container, prefix = paths.split_container(F.regexp_replace("url", "^[a-z]+://", ""))
    return load("pages").select("page_id", container.alias("container"), prefix.alias("prefix"))


@query(
    """SELECT source AS container, count(*) AS files, sum(n_chars)::BIGINT AS bytes,
    round(sum(n_chars)/1048576.0,2)::DOUBLE AS mb FROM documents GROUP BY source"""
)
def inventory_summary(load):
    catalogue = load("documents").select(F.col("source").alias("container"), F.col("n_chars").alias("size"))
    return listing.inventory_summary(catalogue).select("container", "files", "bytes", "mb")


@query("SELECT DISTINCT source AS container FROM documents")
def inventory_containers(load):
    return listing.containers(load("documents").select(F.col("source").alias("container")))


@query(
    """SELECT event_id, event_type||'/'||event_id::VARCHAR AS path FROM events
    WHERE trim(json_extract_string(props,'$.k'))='1'"""
)
def metadata_flag_filter(load):
    metadata = F.create_map(F.lit("Delete"), F.concat(F.lit(" "), F.get_json_object("props", "$.k"), F.lit("\t")))
    tagged = load("events").withColumn("metadata", metadata)
    path = F.concat_ws("/", "event_type", F.col("event_id").cast("string"))
    return listing.flagged_for_deletion(tagged).select("event_id", path.alias("path"))


@query(
    """SELECT p_name, count(*) AS entries FROM part WHERE regexp_matches(p_name,'(?i)RE') GROUP BY p_name"""
)
def name_search_counts(load):
    return listing.name_search_counts(load("part"), "p_name", predicates.text_match("p_name", "RE", regex=True))


def _event_files(load):
    """Every event as a listed file: its type is the container, its number the name."""
    return load("events").select(
        F.col("event_type").alias("container"), F.col("event_id").cast("string").alias("name"), F.col("ts").alias("last_modified")
    )


@query(
    """SELECT event_type||'/'||event_id::VARCHAR||chr(9)||strftime(ts,'%Y-%m-%d %H:%M:%S UTC') AS line FROM events"""
)
def match_lines(load):
    folder = scratch_path(load.spark, "matches")
    listing.write_matches(_event_files(load), folder)
    return load.spark.read.text(folder).withColumnRenamed("value", "line")


@query("SELECT event_type AS container, event_id::VARCHAR AS name FROM events")
def match_lines_read(load):
    """Match list written and read again."""
    folder = scratch_path(load.spark, "matches")
    listing.write_matches(_event_files(load), folder)
    return listing.read_matches(load.spark, folder)


@query(
    """SELECT name FROM (VALUES ('region'),('nation'),('customer'),('supplier'),('part'),('orders'),('lineitem'),
    ('events'),('documents'),('embeddings'),('pages'),('benchmark'),('labels'),('conversations')) t(name)"""
)
def list_given_files(load):
    """The tables' own files, listed in tasks; a table may be one file or a folder of them."""
    found = listing.list_files(load.spark, load.folder)
    top = F.when(F.col("container") == "", F.col("name")).otherwise(F.col("container"))
    top = F.when(F.col("container").endswith(".parquet"), F.col("container")).otherwise(top)
    return found.select(F.regexp_extract(top, r"^([a-z]+)\.parquet$", 1).alias("name")).filter("name <> ''").distinct()


@query(
    """SELECT 'file' AS kind, d.source AS container, d.doc_id::VARCHAR AS name FROM documents d
    WHERE d.source IN ('src0','src3') UNION ALL SELECT 'missing', 'nosuch', NULL"""
)
def allow_listed_containers(load):
    catalogue = load("documents").select(F.col("source").alias("container"), F.col("doc_id").cast("string").alias("name"))
    allowed = files.literal_rows(load.spark, "container string", [("src0",), ("src3",), ("nosuch",), ("src0",), (None,)])
    inside, missing = listing.allow_containers(catalogue, allowed)
    absent = missing.select(F.lit("missing").alias("kind"), "container", F.lit(None).cast("string").alias("name"))
    return inside.select(F.lit("file").alias("kind"), "container", "name").unionByName(absent)


@query(
    """SELECT source AS container, doc_id::VARCHAR AS name, n_chars::VARCHAR AS size FROM documents"""
)
def export_listing_csv(load):
    """The nine export columns, read back as text."""
    folder = scratch_path(load.spark, "export")
    catalogue = load("documents").select(
        F.col("source").alias("container"),
        F.col("doc_id").cast("string").alias("name"),
        F.col("n_chars").alias("size"),
        *[F.lit(None).cast(k).alias(c) for c, k in (("size_mb", "double"), ("last_modified", "timestamp"), ("content_type", "string"))],
        *[F.lit(None).cast(k).alias(c) for c, k in (("blob_type", "string"), ("creation_time", "timestamp"), ("etag", "string"))],
    )
    listing.export_csv(catalogue, folder)
    return load.spark.read.option("header", True).csv(folder).select("container", "name", "size")


@query(
    """SELECT 'orders' AS name, count(*) AS n, 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns
    FROM orders"""
)
def parquet_facts(load):
    facts = files.file_facts(load.spark, load.path("orders"))
    row = ("orders", facts["rows"], ",".join(facts["schema"].names))
    return files.literal_rows(load.spark, "name string, n bigint, columns string", [row])


@query(
    """SELECT n_name AS name FROM nation EXCEPT
    SELECT n_name FROM nation JOIN supplier ON s_nationkey=n_nationkey WHERE s_acctbal<0"""
)
def missing_names(load):
    nations = load("nation").select("n_nationkey", F.col("n_name").alias("name"))
    indebted = load("supplier").filter("s_acctbal < 0").select(F.col("s_nationkey").alias("n_nationkey"))
    return listing.missing_names(nations, nations.join(indebted, "n_nationkey", "left_semi"), "name")


@query(
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20"""
)
def last_rows(load):
    orders = load("orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return clean.tail(orders, [By(F.col("o_orderdate")), By(F.col("o_orderkey"))], 20)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 100 OFFSET 1000")
def page_of_rows(load):
    return clean.page(load("orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 1000, 100)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem WHERE l_partkey < 40 OR l_shipdate < TIMESTAMP '1995-02-01'")
def clustered_scan(load):
    """Lines clustered by part and ship date at once, read back by either."""
    folder = scratch_path(load.spark, "clustered")
    write_clustered(load("lineitem"), folder, ["l_partkey", "l_shipdate"], 16)
    lines = load.spark.read.parquet(folder).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return lines.filter("l_partkey < 40 OR l_shipdate < timestamp '1995-02-01'")


@query(
    """SELECT c.column_name, c.n AS rows, 0::BIGINT AS missing, true AS distinct_is_near, true AS median_is_near FROM
    (SELECT 'l_partkey' AS column_name, count(*) AS n FROM lineitem UNION ALL SELECT 'l_extendedprice', count(*) FROM lineitem) c"""
)
def merged_sketches(load):
    """Statistics of all lines from sketches of each return flag and line status, held against exact ones."""
    lines, names = load("lineitem"), ["l_partkey", "l_extendedprice"]
    whole = sketches.merged(sketches.merged(sketches.sketch(lines, names, ["l_returnflag", "l_linestatus"]), ["l_linestatus"]))
    found = sketches.estimates(whole, [0.5])
    exact = lines.agg(*[F.countDistinct(n).alias(n) for n in names]).unpivot([], names, "column_name", "exact")
    near = found.join(exact, "column_name").withColumn("distinct_is_near", F.abs(F.col("distinct_values") - F.col("exact")) <= 0.05 * F.col("exact"))
    around = lines.agg(*[F.percentile_approx(n, [0.47, 0.53], 10_000) for n in names]).first()
    inside = [(F.col("column_name") == n) & F.col("quantiles")[0].between(*map(float, around[i])) for i, n in enumerate(names)]
    return near.select("column_name", "rows", "missing", "distinct_is_near", (inside[0] | inside[1]).alias("median_is_near"))


@query("SELECT o_orderpriority, count(*) AS orders FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderpriority")
def catalog_table_summary(load):
    """Orders saved as a catalog table and read by its name."""
    name = f"dear_orders_{uuid.uuid4().hex[:12]}"
    files.save_table(load("orders").filter("o_totalprice > 100000"), name)
    return load.spark.table(name).groupBy("o_orderpriority").agg(F.count("*").alias("orders"))


@query(
    """SELECT 'region' AS view, r_name AS name, 2 AS columns FROM region UNION ALL SELECT 'nation', n_name, 3 FROM nation"""
)
def registered_views(load):
    """Views that are listed, described and queried; one that was dropped is not among them."""
    tag, found = uuid.uuid4().hex[:12], None
    for table, columns in (("region", ["r_name", "r_regionkey"]), ("nation", ["n_name", "n_regionkey", "n_nationkey"]), ("supplier", ["s_name"])):
        load(table).select(*columns).createOrReplaceTempView(f"{table}_{tag}")
    files.drop_view(load.spark, f"supplier_{tag}")
    for view in files.list_views(load.spark):
        if view.endswith(tag):
            schema = files.view_schema(load.spark, view)
            rows = files.query_view(load.spark, view).select(
                F.lit(view.removesuffix(f"_{tag}")).alias("view"), F.col(schema.fieldNames()[0]).alias("name"), F.lit(len(schema)).alias("columns")
            )
            found = rows if found is None else found.unionAll(rows)
    return found


@query(
    """SELECT r.id AS custkey FROM (SELECT unnest(range(0, (SELECT max(c_custkey) + 1 FROM customer)::BIGINT)) AS id) r
    WHERE r.id NOT IN (SELECT o_custkey FROM orders)"""
)
def ids_without_orders(load):
    """Every customer number up to the largest that no order bears."""
    last = load("customer").agg(F.max("c_custkey")).first()[0]
    numbers = files.id_range(load.spark, 0, last + 1, "custkey")
    return numbers.join(load("orders").select(F.col("o_custkey").alias("custkey")), "custkey", "left_anti")


@query("SELECT url AS name, page_id FROM pages WHERE starts_with(url, 'https://www.')")
def prefixed_names(load):
    """Page addresses as names of a listing, narrowed by prefix."""
    return listing.with_prefix(load("pages").select(F.col("url").alias("name"), "page_id"), "https://www.")


@query(
    """WITH b AS (SELECT * FROM orders), a AS (SELECT o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN o_orderkey % 5000 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderkey % 9999 <> 3 UNION ALL SELECT * FROM orders WHERE o_orderkey % 7001 = 5)
    SELECT *, 'removed' AS change FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
    UNION ALL SELECT *, 'added' AS change FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)"""
)
def digest_diff(load):
    """Orders before and after a few changes, removals and repeats, found by digests of key ranges."""
    orders, key = load("orders"), F.col("o_orderkey")
    price = F.when(key % 5000 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    after = orders.filter(key % 9999 != 3).withColumn("o_totalprice", price).unionAll(orders.filter(key % 7001 == 5))
    return table_diff(orders, after, "o_orderkey", few=1_000)
