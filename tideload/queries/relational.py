"""Projections, filters, joins, aggregates, sets and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideload.functions.numbers import dispensed_quantity, money
from tideload.operators.joins import attach_one_row, choose_key, lookup_join, not_in, with_match, without_match
from tideload.operators.latest import latest_per_key
from tideload.operators.merge import OPERATION, effective_changes
from tideload.operators.sampling import sample_branches, sample_top
from tideload.operators.updates import update_from, update_when, update_where_in
from tideload.plans.billing import code_complaints, complaint_codes
from tideload.queries.merging import ORDER_CHANGES_SQL, ORDER_COLUMNS, order_changes
from tideload.queries.registry import Tables, query
from tideload.sources.inline import inline_rows

_ORDERS = ", ".join(ORDER_COLUMNS)


def orders_with_key_first(t: Tables) -> DataFrame:
    keys = ["o_orderkey"]
    return t.orders.select(*keys, *sorted(c for c in t.orders.columns if c not in keys))


# Projections and filters


@query(
    "project_key_first",
    "SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_orderstatus, o_totalprice FROM orders",
)
def _project_key_first(t: Tables) -> DataFrame:
    return orders_with_key_first(t)


@query(
    "filter_ops",
    f"SELECT o_orderkey, seq_line, header__operation FROM ({ORDER_CHANGES_SQL}) AS c "
    "WHERE header__operation <> 'BEFOREIMAGE'",
)
def _filter_ops(t: Tables) -> DataFrame:
    return effective_changes(order_changes(t)).select("o_orderkey", "seq_line", OPERATION)


@query(
    "filter_date_range",
    f"SELECT {_ORDERS} FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate <= TIMESTAMP '1998-12-31'",
)
def _filter_date_range(t: Tables) -> DataFrame:
    first, last = (F.lit(d).cast("timestamp_ntz") for d in ("1998-01-01", "1998-12-31"))
    return t.orders.where((F.col("o_orderdate") >= first) & (F.col("o_orderdate") <= last))


@query("filter_in_list", f"SELECT {_ORDERS} FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def _filter_in_list(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))


@query("filter_like", "SELECT p_partkey, p_name FROM part WHERE lower(p_name) = 'small ring'")
def _filter_like(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_name").ilike("SMALL Ring")).select("p_partkey", "p_name")


@query(
    "filter_compound",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE ((l_quantity <> 1 AND l_returnflag = 'R') OR l_discount = 0) AND NOT (l_linestatus = 'O' AND l_tax > 0.05)""",
)
def _filter_compound(t: Tables) -> DataFrame:
    returned = (F.col("l_quantity") != 1) & (F.col("l_returnflag") == "R")
    open_and_taxed = (F.col("l_linestatus") == "O") & (F.col("l_tax") > 0.05)
    kept = t.lineitem.where((returned | (F.col("l_discount") == 0)) & ~open_and_taxed)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey")


# Joins


@query(
    "join_inner",
    "SELECT o_orderkey, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
def _join_inner(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    joined = lookup_join(t.orders.select("o_orderkey", "o_custkey"), customers, ["o_custkey"])
    return joined.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "c_name")


@query(
    "join_composite",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, g.lines FROM lineitem l JOIN (
  SELECT l_orderkey, l_linenumber, count(*) AS lines FROM lineitem GROUP BY ALL) g
ON g.l_orderkey = l.l_orderkey AND g.l_linenumber = l.l_linenumber""",
)
def _join_composite(t: Tables) -> DataFrame:
    key = ["l_orderkey", "l_linenumber"]
    sizes = t.lineitem.groupBy(*key).agg(F.count(F.lit(1)).alias("lines"))
    return lookup_join(t.lineitem.select(*key, "l_partkey"), sizes, key)


@query(
    "join_left_chain",
    """SELECT c_custkey, n_name, r_name FROM customer
LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def _join_left_chain(t: Tables) -> DataFrame:
    nations = t.nation.withColumnRenamed("n_nationkey", "c_nationkey")
    regions = t.region.withColumnRenamed("r_regionkey", "n_regionkey")
    with_nation = lookup_join(t.customer.select("c_custkey", "c_nationkey"), nations, ["c_nationkey"], "left")
    return lookup_join(with_nation, regions, ["n_regionkey"], "left").select("c_custkey", "n_name", "r_name")


@query(
    "join_star",
    """SELECT n_name, p_brand, s_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue, count(*) AS lines
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
GROUP BY n_name, p_brand, s_suppkey""",
)
def _join_star(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", money(F.col("l_extendedprice")).alias("price"))
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    buyers = lookup_join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")),
        t.nation.select("n_nationkey", "n_name"),
        ["n_nationkey"],
    )
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    sellers = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"))
    joined = lookup_join(lines, orders, ["l_orderkey"])
    for dim, key in ((buyers, "o_custkey"), (parts, "l_partkey"), (sellers, "l_suppkey")):
        joined = lookup_join(joined, dim, [key])
    return joined.groupBy("n_name", "p_brand", F.col("l_suppkey").alias("s_suppkey")).agg(
        F.sum("price").alias("revenue"), F.count(F.lit(1)).alias("lines")
    )


@query(
    "join_anti",
    f"SELECT {_ORDERS} FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL",
)
def _join_anti(t: Tables) -> DataFrame:
    return without_match(t.orders, t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"]).select(
        *ORDER_COLUMNS
    )


@query(
    "join_semi_exists",
    f"""SELECT {_ORDERS} FROM orders
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""",
)
def _join_semi_exists(t: Tables) -> DataFrame:
    returned = t.lineitem.where("l_returnflag = 'R'").withColumnRenamed("l_orderkey", "o_orderkey")
    return with_match(t.orders, returned, ["o_orderkey"]).select(*ORDER_COLUMNS)


@query(
    "join_semi_in",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')""",
)
def _join_semi_in(t: Tables) -> DataFrame:
    promo = t.part.where("p_type = 'PROMO'").withColumnRenamed("p_partkey", "l_partkey")
    return with_match(t.lineitem, promo, ["l_partkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "join_not_in",
    f"SELECT {_ORDERS} FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 25)",
)
def _join_not_in(t: Tables) -> DataFrame:
    return not_in(t.orders, "o_orderkey", t.lineitem.where("l_quantity >= 25"), "l_orderkey")


@query(
    "join_cross_onerow",
    f"SELECT {_ORDERS}, 'INV' AS prefix, 'A' AS suffix FROM orders",
)
def _join_cross_onerow(t: Tables) -> DataFrame:
    one = inline_rows(t.spark, [("INV", "A")], "prefix string, suffix string")
    return attach_one_row(t.orders, one, {"prefix": "prefix", "suffix": "suffix"})


@query("empty_like", "SELECT o_orderkey, o_custkey FROM orders")
def _empty_like(t: Tables) -> DataFrame:
    """An empty table of the right shape, then filled."""
    shape = t.orders.select("o_orderkey", "o_custkey").limit(0)
    return shape.unionByName(t.orders.select("o_custkey", "o_orderkey"))


@query(
    "join_or_case_key",
    """SELECT l_orderkey, l_linenumber, p_partkey, p_name FROM lineitem JOIN part
ON (p_partkey = l_partkey AND l_returnflag = 'R') OR (p_partkey = l_suppkey AND l_returnflag = 'A')
  OR (p_partkey = l_suppkey + l_linenumber AND l_returnflag = 'N')""",
)
def _join_or_case_key(t: Tables) -> DataFrame:
    key = choose_key(
        (F.col("l_returnflag") == "R", F.col("l_partkey")),
        (F.col("l_returnflag") == "A", F.col("l_suppkey")),
        (F.col("l_returnflag") == "N", F.col("l_suppkey") + F.col("l_linenumber")),
    )
    keyed = t.lineitem.select("l_orderkey", "l_linenumber", key.alias("p_partkey"))
    return lookup_join(keyed, t.part.select("p_partkey", "p_name"), ["p_partkey"])


_COMPLAINTS = [("click", "chest pain"), ("error", "ABDOMINAL PAIN"), ("view", "Breathing Difficulty"), ("signup", "Fever"), ("purchase", "BREATHING difficulty")]


@query(
    "join_mapping_table",
    """SELECT event_id, complaint, icd_code FROM events
JOIN (VALUES ('click', 'chest pain'), ('error', 'ABDOMINAL PAIN'), ('view', 'Breathing Difficulty'), ('signup', 'Fever'),
             ('purchase', 'BREATHING difficulty'))
  AS m(event_type, complaint) USING (event_type)
JOIN (VALUES ('R07.9', 'Chest Pain'), ('R10', 'Abdominal Pain'), ('R06.8', 'Breathing Difficulty')) AS d(icd_code, text)
  ON (lower(complaint) = 'chest pain' AND icd_code = 'R07.9') OR (lower(complaint) = 'abdominal pain' AND icd_code = 'R10')
  OR (lower(complaint) = 'breathing difficulty' AND icd_code = 'R06.8')""",
)
def _join_mapping_table(t: Tables) -> DataFrame:
    named = inline_rows(t.spark, _COMPLAINTS, "event_type string, complaint string")
    rows = t.events.select("event_id", "event_type").join(named, "event_type")
    return code_complaints(rows, complaint_codes(t.spark)).select("event_id", "complaint", "icd_code")


@query(
    "join_self",
    """SELECT a.o_orderkey, b.o_orderkey AS next_orderkey, a.o_custkey, b.o_custkey AS next_custkey
FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1""",
)
def _join_self(t: Tables) -> DataFrame:
    later = t.orders.select(
        F.col("o_orderkey").alias("next_orderkey"), F.col("o_custkey").alias("next_custkey")
    )
    rows = t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") + 1).alias("next_orderkey"))
    return lookup_join(rows, later, ["next_orderkey"])


# Aggregates


@query(
    "invoice_rollup",
    """SELECT l_orderkey AS invoice_id, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS service_amount,
  sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - l_discount AS DECIMAL(4,2))) AS patient_net_amount,
  sum(CAST(l_quantity AS DECIMAL(18,2))) AS units, count(*) AS lines
FROM lineitem GROUP BY l_orderkey""",
)
def _invoice_rollup(t: Tables) -> DataFrame:
    price = money(F.col("l_extendedprice"))
    return t.lineitem.groupBy(F.col("l_orderkey").alias("invoice_id")).agg(
        F.sum(price).alias("service_amount"),
        F.sum(price * (1 - F.col("l_discount")).cast("decimal(4,2)")).alias("patient_net_amount"),
        F.sum(money(F.col("l_quantity"))).alias("units"),
        F.count(F.lit(1)).alias("lines"),
    )


@query("scalar_sum", "SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS service_amount FROM lineitem")
def _scalar_sum(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.sum(money(F.col("l_extendedprice"))).alias("service_amount"))


@query("max_scalar", "SELECT max(o_orderkey) AS last_id, max(o_orderdate) AS last_date FROM orders")
def _max_scalar(t: Tables) -> DataFrame:
    return t.orders.agg(F.max("o_orderkey").alias("last_id"), F.max("o_orderdate").alias("last_date"))


@query(
    "count_nonnull",
    "SELECT count(*) AS orders, count(CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END) AS settled FROM orders",
)
def _count_nonnull(t: Tables) -> DataFrame:
    settled = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    return t.orders.agg(F.count(F.lit(1)).alias("orders"), F.count(settled).alias("settled"))


@query("distinct_multi", "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def _distinct_multi(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority").distinct()


@query("groupby_dedup", "SELECT l_partkey, l_suppkey FROM lineitem GROUP BY l_partkey, l_suppkey")
def _groupby_dedup(t: Tables) -> DataFrame:
    return t.lineitem.dropDuplicates(["l_partkey", "l_suppkey"]).select("l_partkey", "l_suppkey")


# Order, limit, samples


@query(
    "topk_ordered",
    f"SELECT {_ORDERS} FROM orders ORDER BY CAST(o_totalprice AS DECIMAL(18,2)) DESC, o_orderkey LIMIT 25",
)
def _topk_ordered(t: Tables) -> DataFrame:
    return t.orders.orderBy(money(F.col("o_totalprice")).desc(), "o_orderkey").limit(25)


@query(
    "sample_topn",
    f"SELECT {_ORDERS} FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '-42'), o_orderkey LIMIT 50",
)
def _sample_topn(t: Tables) -> DataFrame:
    return sample_top(t.orders, "o_orderkey", 50)


@query(
    "sample_stratified",
    f"""SELECT {_ORDERS} FROM (
  SELECT * FROM (SELECT {_ORDERS} FROM orders WHERE o_orderstatus = 'F'
                 ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '-42'), o_orderkey LIMIT 20) AS f
  UNION
  SELECT * FROM (SELECT {_ORDERS} FROM orders WHERE o_orderpriority = '1-URGENT'
                 ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '-42'), o_orderkey LIMIT 30) AS u
) AS b ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '-42'), o_orderkey LIMIT 40""",
)
def _sample_stratified(t: Tables) -> DataFrame:
    branches = [(F.col("o_orderstatus") == "F", 20), (F.col("o_orderpriority") == "1-URGENT", 30)]
    return sample_branches(t.orders, branches, "o_orderkey", 40)


# Sets


@query(
    "union_all",
    "SELECT n_nationkey AS key FROM nation UNION ALL SELECT c_nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier",
)
def _union_all(t: Tables) -> DataFrame:
    return (
        t.nation.select(F.col("n_nationkey").alias("key"))
        .unionByName(t.customer.select(F.col("c_nationkey").alias("key")))
        .unionByName(t.supplier.select(F.col("s_nationkey").alias("key")))
    )


@query(
    "union_distinct",
    "SELECT c_nationkey AS nation, c_mktsegment AS label FROM customer UNION SELECT s_nationkey, 'SUPPLIER' FROM supplier",
)
def _union_distinct(t: Tables) -> DataFrame:
    buyers = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("label"))
    sellers = t.supplier.select(F.col("s_nationkey").alias("nation"), F.lit("SUPPLIER").alias("label"))
    return buyers.unionByName(sellers).distinct()


# Subqueries


@query(
    "subquery_scalar",
    f"SELECT {_ORDERS} FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders) - INTERVAL 365 DAY",
)
def _subquery_scalar(t: Tables) -> DataFrame:
    newest = t.orders.agg(F.max("o_orderdate")).scalar()
    return t.orders.where(F.col("o_orderdate") > newest - F.make_dt_interval(F.lit(365)))


@query(
    "subquery_correlated_top1",
    """SELECT o_orderkey, l_partkey, l_suppkey, l_quantity FROM orders LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice) AS first FROM lineitem) AS l
ON l_orderkey = o_orderkey AND first = 1""",
)
def _subquery_correlated_top1(t: Tables) -> DataFrame:
    order = [F.col(c).asc() for c in ("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")]
    first = latest_per_key(t.lineitem, ["l_orderkey"], order).select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey", "l_quantity"
    )
    return lookup_join(t.orders.select("o_orderkey"), first, ["o_orderkey"], "left")


# Updates


@query(
    "update_from_join",
    """SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'F' THEN 'Confirmed' WHEN 'O' THEN 'Tentative'
  ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
)
def _update_from_join(t: Tables) -> DataFrame:
    names = inline_rows(t.spark, [("F", "Confirmed"), ("O", "Tentative")], "o_orderstatus string, name string")
    return update_from(t.orders, names, ["o_orderstatus"], {"o_orderstatus": "name"}).select(*ORDER_COLUMNS)


@query(
    "update_where_in",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount >= 0.1)
  THEN 'D' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
)
def _update_where_in(t: Tables) -> DataFrame:
    discounted = t.lineitem.where("l_discount >= 0.1D").select(F.col("l_orderkey").alias("o_orderkey"))
    return update_where_in(t.orders, discounted, ["o_orderkey"], {"o_orderstatus": F.lit("D")}).select(*ORDER_COLUMNS)


@query(
    "update_expr",
    """SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(CASE WHEN l_returnflag = 'N' THEN ceil(l_quantity * 0.5 * l_linenumber) ELSE l_quantity END AS BIGINT) AS quantity
FROM lineitem""",
)
def _update_expr(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", F.col("l_quantity").cast("bigint").alias("quantity")
    )
    needed = dispensed_quantity(F.lit(0.5), F.col("quantity"), F.col("l_linenumber"))
    return update_when(rows, F.col("l_returnflag") == "N", {"quantity": needed}).drop("l_returnflag")
