"""J (joins), W (numbering, ranking, one record per key), O (order and limits), U (set operations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.catalog.registry import Tables, query
from cadastra.catalog.standins import UNTIED
from cadastra.operators import dedupe, digests, filters, joins, sets, windows
from cadastra.operators.joins import Lookup
from cadastra.sources.staging import fresh_dir

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
_ORDER_SQL = ", ".join(ORDER_COLUMNS)


def _in_year(df, year: int):
    return df.where(
        (F.col("o_orderdate") >= F.lit(f"{year}-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz"))
    )


# --- joins -----------------------------------------------------------------------------------


@query("j01_inner_join", """
SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(t: Tables):
    named = joins.enrich(
        t.orders.select("o_orderkey", "o_custkey"),
        Lookup(t.customer, {"o_custkey": "c_custkey"}, ["c_name", "c_mktsegment"], "inner"),
    )
    return named.drop("o_custkey")


@query("j02_left_join", """
SELECT c_custkey, o_orderkey FROM customer LEFT JOIN
(SELECT * FROM orders WHERE o_totalprice > 400000) o ON c_custkey = o_custkey""")
def _(t):
    large = t.orders.where(F.col("o_totalprice") > 400000)
    orders = Lookup(large, {"c_custkey": "o_custkey"}, ["o_orderkey"], many=True)
    return joins.enrich(t.customer.select("c_custkey"), orders)


@query("j03_right_join", """
SELECT c_name, o_orderkey FROM (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') c
RIGHT JOIN orders ON c_custkey = o_custkey""")
def _(t):
    building = t.customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    orders = t.orders.select("o_custkey", "o_orderkey")
    joined = building.join(orders, building["c_custkey"] == orders["o_custkey"], "right")
    return joined.select("c_name", "o_orderkey")


@query("j04_multi_column_join", """
WITH p AS (SELECT l_returnflag, l_linestatus, year(l_shipdate)::INTEGER AS year, round(avg(l_extendedprice), 4) AS mean_price
           FROM lineitem GROUP BY ALL),
     q AS (SELECT l_returnflag, l_linestatus, year(l_shipdate)::INTEGER AS year, sum(l_quantity) AS quantity
           FROM lineitem GROUP BY ALL)
SELECT l_returnflag, l_linestatus, year, mean_price, quantity FROM p JOIN q USING (l_returnflag, l_linestatus, year)""")
def _(t):
    keys = ["l_returnflag", "l_linestatus", "year"]
    line = t.lineitem.withColumn("year", F.year("l_shipdate"))
    price = line.groupBy(*keys).agg(F.round(F.avg("l_extendedprice"), 4).alias("mean_price"))
    quantity = line.groupBy(*keys).agg(F.sum("l_quantity").alias("quantity"))
    return price.join(quantity, keys)


@query("j05_join_projected", """
SELECT o_orderkey, c_custkey, c_mktsegment FROM orders JOIN (SELECT c_custkey, c_mktsegment FROM customer) c
ON o_custkey = c_custkey""")
def _(t):
    narrow = t.customer.select("c_custkey", "c_mktsegment")
    orders = t.orders.select("o_orderkey", "o_custkey")
    return orders.join(narrow, orders["o_custkey"] == narrow["c_custkey"]).drop("o_custkey")


@query("j06_anti_join", """
SELECT c_custkey FROM customer WHERE NOT EXISTS
(SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = 1997)""")
def _(t):
    return joins.drop_listed(t.customer.select("c_custkey"), _in_year(t.orders, 1997), {"c_custkey": "o_custkey"})


_REGISTERS = """
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE year(o_orderdate) = 1996),
     b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE year(o_orderdate) = 1997)"""


@query("j07_presence_by_area", _REGISTERS + """
SELECT c_nationkey, count(*) AS n_keys, count(a.k) AS n_in_a, count(b.k) AS n_in_b,
       count(CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 1 END) AS n_in_both,
       round(count(a.k) / count(*), 6) AS fraction_in_a, round(count(b.k) / count(*), 6) AS fraction_in_b
FROM a FULL JOIN b ON a.k = b.k JOIN customer ON c_custkey = coalesce(a.k, b.k) GROUP BY 1""")
def _(t):
    # Distinct customers per year first: the join with the customer table then sees each only once.
    area = Lookup(t.customer, {"o_custkey": "c_custkey"}, ["c_nationkey"], "inner")
    first, second = (
        joins.enrich(_in_year(t.orders, y).select("o_custkey").distinct(), area) for y in (1996, 1997)
    )
    report = joins.presence_by_area(first, second, "o_custkey", "c_nationkey")
    return report.withColumns({c: F.round(c, 6) for c in ("fraction_in_a", "fraction_in_b")})


@query("j08_matched_share", _REGISTERS + """
SELECT count(*) AS n_keys, count(b.k) AS n_matched, round(count(b.k) * 100.0 / count(*), 6) AS matched_pct
FROM a LEFT JOIN b ON a.k = b.k""")
def _(t):
    share = joins.matched_share(_in_year(t.orders, 1996), _in_year(t.orders, 1997), "o_custkey")
    return share.withColumn("matched_pct", F.round("matched_pct", 6))


@query("j09_star_enrichment", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, s_name, s.n_name, r_name, p_type, s_nationkey, n_regionkey
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation s ON s_nationkey = s.n_nationkey
LEFT JOIN region ON s.n_regionkey = r_regionkey LEFT JOIN part ON l_partkey = p_partkey""")
def _(t):
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity")
    # An arm of lookups is joined up first, so the fact table meets it once.
    place = joins.enrich(
        t.supplier,
        Lookup(t.nation, {"s_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"]),
        Lookup(t.region, {"n_regionkey": "r_regionkey"}, ["r_name"]),
    )
    return joins.enrich(
        fact,
        Lookup(place, {"l_suppkey": "s_suppkey"}, ["s_name", "s_nationkey", "n_name", "n_regionkey", "r_name"]),
        Lookup(t.part, {"l_partkey": "p_partkey"}, ["p_type"]),
    ).drop("l_partkey")


_LATEST_TIES = f"""
SELECT {_ORDER_SQL} FROM orders JOIN (SELECT o_custkey AS k, max(o_orderdate) AS d FROM orders GROUP BY 1) m
ON o_custkey = k AND o_orderdate = d"""


@query("j10_latest_by_join_back", _LATEST_TIES)
def _(t):
    return dedupe.latest_with_ties(t.orders, "o_custkey", "o_orderdate").select(*ORDER_COLUMNS)


@query("j11_distinct_lookup", """
SELECT o_orderkey, d.c_nationkey FROM orders JOIN (SELECT DISTINCT c_custkey, c_nationkey FROM customer) d
ON o_custkey = c_custkey""")
def _(t):
    lookup = t.customer.select("c_custkey", "c_nationkey").distinct()
    joined = joins.enrich(
        t.orders.select("o_orderkey", "o_custkey"), Lookup(lookup, {"o_custkey": "c_custkey"}, ["c_nationkey"], "inner")
    )
    return joined.drop("o_custkey")


@query("j12_side_by_side_columns", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS FLOAT) AS l_quantity, CAST(l_tax AS FLOAT) AS l_tax FROM lineitem""")
def _(t):
    # Columns made from the same rows stay in one projection; nothing is matched by position.
    ids, measures = ["l_orderkey", "l_linenumber"], ["l_quantity", "l_tax"]
    return t.lineitem.select(*ids, *[F.col(c).cast("float").alias(c) for c in measures])


# --- numbering, ranking, one record per key --------------------------------------------------


@query("w01_global_row_number", """
SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS row_number FROM orders""")
def _(t):
    return windows.row_numbers(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey", "o_orderkey"])


@query("w02_latest_row_per_key", f"""
SELECT {_ORDER_SQL} FROM (SELECT *, row_number() OVER
    (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def _(t):
    return dedupe.latest_row(t.orders, "o_custkey", "o_orderdate", "o_orderkey").select(*ORDER_COLUMNS)


@query("w02_first_of_latest", f"""
SELECT {_ORDER_SQL} FROM (SELECT *, row_number() OVER
    (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def _(t):
    return dedupe.first_of_latest(t.orders, "o_custkey", "o_orderdate", "o_orderkey").select(*ORDER_COLUMNS)


_EVENTS_NULLS = """(SELECT event_id, nullif(user_id, 7) AS user_id, event_type, value,
    CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS ts FROM events)"""


def _events_with_nulls(t: Tables):
    """One user without a key and errors without a time."""
    return t.events.select(
        "event_id", F.nullif("user_id", F.lit(7).cast("bigint")).alias("user_id"), "event_type", "value",
        F.when(F.col("event_type") != "error", F.col("ts")).alias("ts"),
    )


@query("w03_last_after_sort", f"""
SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM {_EVENTS_NULLS}) WHERE rn = 1""")
def _(t):
    last = dedupe.last_after_sort(_events_with_nulls(t), "user_id", ["ts", "event_id"])
    return last.select("user_id", "event_id", "event_type", "value")


@query("w04_average_rank", """
SELECT c_custkey, rank() OVER (ORDER BY bal) + (count(*) OVER (PARTITION BY bal) - 1) / 2 AS rank
FROM (SELECT c_custkey, floor(c_acctbal / 10) AS bal FROM customer)""")
def _(t):
    tens = t.customer.select("c_custkey", F.floor(F.col("c_acctbal") / 10).alias("bal"))
    return windows.rank_of_values(tens, "bal").select("c_custkey", "rank")


@query("w05_placement", """
WITH m AS (SELECT n_name, year(o_orderdate)::INTEGER AS year, avg(o_totalprice) AS mean_price
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
     p AS (SELECT n_name, year, (count(*) OVER (PARTITION BY year)
             - (rank() OVER (PARTITION BY year ORDER BY mean_price) - 1) * 1.0)::DOUBLE AS place FROM m)
SELECT n_name, year, place, CAST(floor(place) AS BIGINT) || CASE WHEN floor(place) % 100 BETWEEN 11 AND 13 THEN 'th'
    WHEN floor(place) % 10 = 1 THEN 'st' WHEN floor(place) % 10 = 2 THEN 'nd' WHEN floor(place) % 10 = 3 THEN 'rd'
    ELSE 'th' END AS place_text FROM p""")
def _(t):
    means = _by_nation_and_year(t, F.sum("o_totalprice").alias("total"), F.count("*").alias("n")).groupBy(
        "n_name", "year"
    ).agg((F.sum("total") / F.sum("n")).alias("mean_price"))
    return windows.placement(means, "mean_price", "year").select("n_name", "year", "place", "place_text")


def _by_nation_and_year(t: Tables, *per_customer):
    """Orders aggregated per customer and year first, so the joins see one row per customer and year."""
    yearly = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(*per_customer)
    return joins.enrich(
        yearly,
        Lookup(t.customer, {"o_custkey": "c_custkey"}, ["c_nationkey"], "inner"),
        Lookup(t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"], "inner"),
    )


@query("w06a_latest_with_ties", _LATEST_TIES)
def _(t):
    return dedupe.latest_of_group(t.orders, "o_custkey", "o_orderdate").select(*ORDER_COLUMNS)


@query("w06a_latest_with_ties_nulls", f"""
SELECT user_id, event_id, value FROM (SELECT *, rank() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST) AS r
FROM {_EVENTS_NULLS}) WHERE r = 1""")
def _(t):
    ties = dedupe.latest_of_group(_events_with_nulls(t), "user_id", "ts")
    return ties.select("user_id", "event_id", "value")


@query("w06b_latest_overall", """
SELECT event_id, user_id, CAST(ts AS VARCHAR) AS ts FROM events ORDER BY events.ts DESC, event_id DESC LIMIT 1""")
def _(t):
    return dedupe.latest_overall(t.events, "ts", "event_id").select("event_id", "user_id", F.col("ts").cast("string"))


_YEARLY_SQL = """
WITH y AS (SELECT n_name, year(o_orderdate)::INTEGER AS year, sum(o_totalprice) AS revenue
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)"""


@query("w07_running_total", _YEARLY_SQL + """
SELECT n_name, year, round(revenue, 2) AS revenue,
       round(sum(revenue) OVER (PARTITION BY n_name ORDER BY year ROWS UNBOUNDED PRECEDING), 2) AS cumulative FROM y""")
def _(t):
    revenue = _by_nation_and_year(t, F.sum("o_totalprice").alias("revenue"))
    running = windows.running_total(revenue, "n_name", "year", "revenue", "cumulative")
    return running.select("n_name", "year", F.round("revenue", 2).alias("revenue"), F.round("cumulative", 2).alias("cumulative"))


@query("w08_running_total_per_area", _YEARLY_SQL + """,
c AS (SELECT n_name, count(*) * 0.70710678 AS area FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
SELECT n_name, year, round(sum(revenue) OVER (PARTITION BY n_name ORDER BY year ROWS UNBOUNDED PRECEDING)
       / area / 1000, 6) AS per_area FROM y JOIN c USING (n_name)""")
def _(t):
    revenue = _by_nation_and_year(t, F.sum("o_totalprice").alias("revenue"))
    running = windows.running_total(revenue, "n_name", "year", "revenue", "cumulative")
    counts = t.customer.groupBy("c_nationkey").agg((F.count("*") * UNTIED).alias("area"))
    areas = joins.enrich(counts, Lookup(t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"], "inner"))
    joined = joins.enrich(running, Lookup(areas, {"n_name": "n_name"}, ["area"], "inner"))
    return joined.select("n_name", "year", F.round(F.col("cumulative") / F.col("area") / 1000, 6).alias("per_area"))


@query("w09_drop_repeated_keys", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE (o_custkey, o_orderdate) IN
(SELECT (o_custkey, o_orderdate) FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) = 1)""")
def _(t):
    return dedupe.drop_repeated_keys(t.orders, ["o_custkey", "o_orderdate"]).select("o_orderkey", "o_custkey", "o_totalprice")


_LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("w03_last_per_source", """
SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER
    (PARTITION BY l_returnflag, l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
     l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""")
def _(t):
    last = dedupe.last_per_source(t.lineitem, "l_returnflag", "l_orderkey", _LINE_ORDER)
    return last.select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("w10_first_per_subset", f"""
SELECT {_ORDER_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS rn
FROM orders) WHERE rn = 1""")
def _(t):
    return dedupe.first_per_subset(t.orders, ["o_custkey", "o_orderpriority"], "o_orderkey").select(*ORDER_COLUMNS)


@query("w11_batch_numbers", """
SELECT c_custkey, CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / 100) AS BIGINT) AS batch FROM customer""")
def _(t):
    return windows.batch_numbers(t.customer, "c_custkey", 100)


# --- order and limits ------------------------------------------------------------------------


@query("o01_multi_key_sort", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice DESC, o_orderkey")
def _(t):
    picked = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return picked.orderBy("o_custkey", F.desc("o_totalprice"), "o_orderkey")


@query("o02_top_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("o03_sample_exact_size", """
SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 500""")
def _(t):
    return filters.sample_rows(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", 500, 42)


@query("o03_sample_per_area", """
SELECT o_orderkey, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('7:' || o_orderkey), o_orderkey) <= 40""")
def _(t):
    return filters.sample_rows_per_area(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey", 40, 7)


@query("o04_default_page", """
SELECT event_id, user_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 20""")
def _(t):
    page = t.events.orderBy(F.desc("ts"), F.desc("event_id")).limit(20)
    return page.select("event_id", "user_id", "event_type", "value")


# --- set operations --------------------------------------------------------------------------


@query("u01_union_all", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'""")
def _(t):
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    halves = [orders.where(c).drop("o_orderstatus") for c in ("o_orderstatus = 'F'", "o_orderstatus <> 'F'")]
    return sets.unite(*halves)


@query("u02_union_widened", """
SELECT CAST(c_nationkey AS BIGINT) AS key FROM customer UNION ALL SELECT s_suppkey FROM supplier""")
def _(t):
    return sets.unite(t.customer.select(F.col("c_nationkey").alias("key")), t.supplier.select(F.col("s_suppkey").alias("key")))


@query("u03_union_tagged", """
SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, 'customer' AS source FROM customer
UNION ALL SELECT s_name, s_acctbal, NULL, 'supplier' FROM supplier""")
def _(t):
    customer = t.customer.select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    supplier = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return sets.unite_tagged({"customer": customer, "supplier": supplier}, "source")


@query("u04_append_row_and_relabel", """
WITH n AS (SELECT c_nationkey AS nation, CASE WHEN c_mktsegment = 'BUILDING' THEN 'BUILDING (inc extra)' ELSE c_mktsegment
           END AS segment, c_custkey FROM customer UNION ALL SELECT 99, 'BUILDING (inc extra)', 0)
SELECT nation, segment, count(*) AS n FROM n GROUP BY ALL""")
def _(t):
    base = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), "c_custkey")
    segment = F.col("segment")
    relabelled = F.when(segment == "BUILDING", "BUILDING (inc extra)").otherwise(segment)
    extended = sets.append_rows(base, [(99, "BUILDING", 0)]).withColumn("segment", relabelled)
    return extended.groupBy("nation", "segment").agg(F.count("*").alias("n"))


@query("u05_union_distinct", """
SELECT c_nationkey AS nation, c_mktsegment AS label FROM customer UNION SELECT s_nationkey, 'SUPPLIER' FROM supplier""")
def _(t):
    customer = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("label"))
    supplier = t.supplier.select(F.col("s_nationkey").alias("nation"), F.lit("SUPPLIER").alias("label"))
    return sets.unite_distinct(customer, supplier)


@query("u06_key_difference", """
SELECT o_custkey FROM orders EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'""")
def _(t):
    return sets.key_difference(t.orders, t.orders.where(F.col("o_orderpriority") == "1-URGENT"), "o_custkey")


@query("u07_table_equality", """
SELECT 'same' AS pair, 0::BIGINT AS n_differing, true AS identical
UNION ALL SELECT 'changed', count(DISTINCT (o_orderkey, o_totalprice)) * 2, count(*) = 0
FROM orders WHERE o_orderstatus = 'P'""")
def _(t):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    reread = t.orders.select("o_totalprice", "o_orderkey")
    price = F.col("o_totalprice")
    changed = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", price + 1).otherwise(price).alias("o_totalprice")
    )
    reports = {"same": sets.same_rows(orders, reread), "changed": sets.same_rows(orders, changed)}
    return sets.unite_tagged(reports, "pair")


@query("u07_stored_differences", """
SELECT o_orderkey, o_totalprice, side::BIGINT AS surplus FROM (
    SELECT o_orderkey, o_totalprice, 1 AS side FROM orders WHERE o_orderkey % 997 = 5
    UNION ALL SELECT o_orderkey, o_totalprice + 1, -1 FROM orders WHERE o_orderkey % 997 = 5
    UNION ALL SELECT o_orderkey, o_totalprice, -1 FROM orders WHERE o_orderkey % 1999 = 7
    UNION ALL SELECT -o_orderkey, o_totalprice, -1 FROM orders WHERE o_orderkey % 1499 = 3)""")
def _(t):
    # The second version has changed, repeated and added rows.
    orders = t.orders.select("o_orderkey", "o_totalprice")
    changed = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 997 == 5, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    repeated = orders.where("o_orderkey % 1999 = 7")
    added = orders.where("o_orderkey % 1499 = 3").withColumn("o_orderkey", -F.col("o_orderkey"))
    one, two = (fresh_dir(t.spark, f"u07-{version}") for version in ("one", "two"))
    digests.store_digested(orders, one, "o_orderkey", 64)
    digests.store_digested(changed.unionAll(repeated).unionAll(added), two, "o_orderkey", 64)
    return digests.stored_differences(t.spark, one, two, orders.schema)
