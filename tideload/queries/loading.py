"""Sources, sinks, metadata, extracts, audit and publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideload.functions.numbers import money
from tideload.operators.audit import advance_watermark, count_rows, init_watermark, key_check, latest_counts, record_counts
from tideload.operators.cells import to_cells, to_mutations
from tideload.operators.merge import DELETE, OPERATION, TIMESTAMP, compact_changes, merge_changes
from tideload.operators.publish import (
    VersionedTable,
    append_rows,
    bucket_count,
    drop_table,
    ensure_table,
    full_load,
    publish_swap,
    save_table,
    truncate_table,
)
from tideload.operators.ranged import RangedTable
from tideload.plans.cycles import ChangeCycles, run_change_files
from tideload.plans.extracts import control_of, landed_rows, ledger_of, run_extracts, vacuum_landing
from tideload.plans.loads import (
    LoadSpec,
    load_discovered,
    run_all,
    run_full,
    run_full_ranged,
    run_incremental,
    run_incremental_ranged,
)
from tideload.queries.merging import (
    ORDER_CHANGES_SQL,
    ORDER_COLUMNS,
    ORDER_KEY,
    ORDER_MERGE_SQL,
    ORDER_TIEBREAK,
    order_changes,
)
from tideload.queries.registry import TABLES, Tables, query
from tideload.sources.cellstore import FileCells, write_mutations
from tideload.sources.delimited import CHANGE_HEADER, change_rows, read_changes, read_changes_checked, read_snapshot, write_snapshot
from tideload.sources.extract import balanced_predicates, extract_full, extract_since, land, parquet_reader, read_split
from tideload.sources.inline import inline_rows
from tideload.sources.metadata import (
    Field,
    TableMeta,
    discover_metadata,
    discover_metadata_by_constraint,
    discover_tables,
    meta_of,
    metadata_frame,
    read_metadata,
    table_metas,
    write_metadata,
)

_ALL_ORDERS_SQL = f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders"

# The key columns the given tables are known to have.
TABLE_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
}


def order_meta(t: Tables):
    return meta_of("orders", t.orders.schema, ORDER_KEY)


@query("scan_snapshot", _ALL_ORDERS_SQL)
def _scan_snapshot(t: Tables) -> DataFrame:
    path = t.scratch("snapshot")
    write_snapshot(t.orders, path)
    return read_snapshot(t.spark, path, order_meta(t))


def change_sequence():
    """A text that sorts like (line number, part)."""
    return F.concat(F.lpad("seq_line", 6, "0"), F.lpad("seq_part", 20, "0"))


def order_change_rows(t: Tables) -> DataFrame:
    """All order changes in the layout of a change file."""
    changes = order_changes(t)
    return change_rows(changes, ORDER_COLUMNS, F.col(OPERATION), F.col(TIMESTAMP), change_sequence())


CHANGE_FILE_TIEBREAK = ["h5", *ORDER_TIEBREAK[2:]]
CHANGE_FILE_SQL = f"""
SELECT {', '.join(ORDER_COLUMNS)}, header__operation, header__timestamp,
       lpad(CAST(seq_line AS VARCHAR), 6, '0') || lpad(CAST(seq_part AS VARCHAR), 20, '0') AS h5
FROM ({ORDER_CHANGES_SQL}) AS c"""


@query("scan_changes", CHANGE_FILE_SQL)
def _scan_changes(t: Tables) -> DataFrame:
    path = t.scratch("changes")
    write_snapshot(order_change_rows(t), path)
    changes = read_changes(t.spark, path, order_meta(t))
    return changes.select(*ORDER_COLUMNS, "header__operation", TIMESTAMP, "h5")


@query(
    "metadata_keys",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{','.join(keys)}' AS key_columns, count(*) AS rows, "
        f"count(DISTINCT ({', '.join(keys)})) AS distinct_keys FROM {name}"
        for name, keys in TABLE_KEYS.items()
    ),
)
def _metadata_keys(t: Tables) -> DataFrame:
    """Keys are read back from metadata files and checked against the rows of every table."""
    path = t.scratch("metadata")
    metas = [meta_of(name, getattr(t, name).schema, keys) for name, keys in TABLE_KEYS.items()]
    write_metadata(metadata_frame(t.spark, metas), path)
    found = table_metas(read_metadata(t.spark, path))
    return key_check({name: (getattr(t, name), meta.keys) for name, meta in found.items()})


# Roles for the catalog views: orders are tables, their lines are the columns, parts
# are the types. The line numbers flagged R form the index of a table, and the index
# of an open order is its primary key.
@query(
    "discover_metadata",
    """
WITH columns_ AS (
  SELECT l_orderkey AS object_id, l_linenumber AS column_id, min(l_partkey) AS user_type_id,
         'c' || CAST(l_linenumber AS VARCHAR) AS column_name FROM lineitem GROUP BY 1, 2),
types AS (SELECT p_partkey AS user_type_id, p_name AS type_name FROM part),
index_columns AS (SELECT DISTINCT l_orderkey AS object_id, l_linenumber AS column_id FROM lineitem
                  WHERE l_returnflag = 'R'),
indexes AS (SELECT o_orderkey AS object_id, o_orderstatus = 'O' AS is_primary_key FROM orders),
flagged AS (
  SELECT c.object_id, c.column_name AS field_name, t.type_name AS data_type,
         coalesce(CAST(i.is_primary_key AS INTEGER), 0) AS is_primary
  FROM columns_ c JOIN types t USING (user_type_id)
  LEFT JOIN index_columns ic ON ic.object_id = c.object_id AND ic.column_id = c.column_id
  LEFT JOIN indexes i ON i.object_id = ic.object_id)
SELECT * FROM flagged
WHERE object_id IN (SELECT object_id FROM flagged WHERE is_primary = 1)
ORDER BY object_id, is_primary DESC, field_name""",
)
def _discover_metadata(t: Tables) -> DataFrame:
    columns = t.lineitem.groupBy(F.col("l_orderkey").alias("object_id"), F.col("l_linenumber").alias("column_id")).agg(
        F.min("l_partkey").alias("user_type_id")
    )
    columns = columns.withColumn("column_name", F.concat(F.lit("c"), F.col("column_id").cast("string")))
    types = t.part.select(F.col("p_partkey").alias("user_type_id"), F.col("p_name").alias("type_name"))
    index_columns = (
        t.lineitem.where("l_returnflag = 'R'")
        .select(F.col("l_orderkey").alias("object_id"), F.col("l_linenumber").alias("column_id"), F.lit(1).alias("index_id"))
        .distinct()
    )
    indexes = t.orders.select(
        F.col("o_orderkey").alias("object_id"),
        F.lit(1).alias("index_id"),
        (F.col("o_orderstatus") == "O").alias("is_primary_key"),
    )
    return discover_metadata(columns, types, index_columns, indexes)


# Roles for the constraint views: an order is a table with one constraint, a primary key
# if the order is open; the lines flagged R are the constrained columns.
@query(
    "discover_pk_union",
    """
WITH tc AS (SELECT 'public' AS constraint_schema, 'k' || CAST(o_orderkey AS VARCHAR) AS constraint_name,
                   't' || CAST(o_orderkey AS VARCHAR) AS table_name,
                   CASE WHEN o_orderstatus = 'O' THEN 'PRIMARY KEY' ELSE 'CHECK' END AS constraint_type FROM orders),
ccu AS (SELECT 'public' AS constraint_schema, 'k' || CAST(l_orderkey AS VARCHAR) AS constraint_name,
               'c' || CAST(l_linenumber AS VARCHAR) AS column_name FROM lineitem WHERE l_returnflag = 'R'),
col AS (SELECT 'public' AS table_schema, 't' || CAST(l_orderkey AS VARCHAR) AS table_name,
               'c' || CAST(l_linenumber AS VARCHAR) AS column_name, l_linestatus AS data_type FROM lineitem),
pk AS (SELECT DISTINCT c.table_name, c.column_name, c.data_type
       FROM tc JOIN ccu USING (constraint_schema, constraint_name)
       JOIN col c ON c.table_schema = tc.constraint_schema AND c.table_name = tc.table_name
                 AND c.column_name = ccu.column_name
       WHERE tc.constraint_type = 'PRIMARY KEY')
SELECT table_name, column_name, data_type, 1 AS pk FROM pk
UNION
SELECT DISTINCT c.table_name, c.column_name, c.data_type, 0
FROM tc JOIN col c ON c.table_schema = tc.constraint_schema AND c.table_name = tc.table_name
WHERE NOT EXISTS (SELECT 1 FROM pk WHERE pk.table_name = c.table_name AND pk.column_name = c.column_name)""",
)
def _discover_pk_union(t: Tables) -> DataFrame:
    def named(prefix: str, column: str):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    schema = F.lit("public")
    constraints = t.orders.select(
        schema.alias("constraint_schema"),
        named("k", "o_orderkey").alias("constraint_name"),
        named("t", "o_orderkey").alias("table_name"),
        F.when(F.col("o_orderstatus") == "O", "PRIMARY KEY").otherwise("CHECK").alias("constraint_type"),
    )
    constrained = t.lineitem.where("l_returnflag = 'R'").select(
        schema.alias("constraint_schema"),
        named("k", "l_orderkey").alias("constraint_name"),
        named("c", "l_linenumber").alias("column_name"),
    )
    columns = t.lineitem.select(
        schema.alias("table_schema"),
        named("t", "l_orderkey").alias("table_name"),
        named("c", "l_linenumber").alias("column_name"),
        F.col("l_linestatus").alias("data_type"),
    )
    return discover_metadata_by_constraint(constraints, constrained, columns)


@query("extract_full", "SELECT * FROM customer")
def _extract_full(t: Tables) -> DataFrame:
    return extract_full(parquet_reader(t.spark, t.folder), "customer")


def _control(t: Tables) -> DataFrame:
    empty = t.spark.createDataFrame([], "table_name string, run_time timestamp_ntz")
    control = init_watermark(empty, "orders", F.lit("2000-01-01").cast("timestamp_ntz"))
    return init_watermark(control, "lineitem", F.lit("2001-01-01").cast("timestamp_ntz"))


@query(
    "extract_since_watermark",
    f"""SELECT {', '.join(ORDER_COLUMNS)} FROM orders WHERE o_orderdate > (
  SELECT run_time FROM (VALUES ('orders', TIMESTAMP '2000-01-01'), ('lineitem', TIMESTAMP '2001-01-01'))
      AS control(table_name, run_time) WHERE table_name = 'orders')""",
)
def _extract_since(t: Tables) -> DataFrame:
    return extract_since(t.orders, "o_orderdate", _control(t), "orders")


@query(
    "advance_watermark",
    """
SELECT 'orders' AS table_name, greatest(TIMESTAMP '2000-01-01', max(o_orderdate)) AS run_time
FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'
UNION ALL
SELECT 'lineitem', greatest(TIMESTAMP '2001-01-01', max(l_shipdate))
FROM lineitem WHERE l_shipdate > TIMESTAMP '2001-01-01'""",
)
def _advance_watermark(t: Tables) -> DataFrame:
    control = _control(t)
    for table, df, ts in (("orders", t.orders, "o_orderdate"), ("lineitem", t.lineitem, "l_shipdate")):
        control = advance_watermark(control, extract_since(df, ts, control, table, pushed=False), ts, table)
    return control


@query("land_roundtrip", f"{_ALL_ORDERS_SQL} UNION ALL {_ALL_ORDERS_SQL} WHERE o_orderdate > TIMESTAMP '2000-01-01'")
def _land(t: Tables) -> DataFrame:
    """A full extract, then an incremental one next to it."""
    folder = t.scratch("landing")
    land(t.orders, folder, "overwrite")
    land(extract_since(t.orders, "o_orderdate", _control(t), "orders"), folder, "append")
    return t.spark.read.parquet(folder)


@query(
    "run_extracts",
    """
SELECT 'orders' AS kind, CAST(o_orderkey AS BIGINT) AS id, o_orderdate AS at FROM orders
UNION ALL SELECT 'lineitem', l_orderkey, l_shipdate FROM lineitem
UNION ALL SELECT 'control orders', NULL, max(o_orderdate) FROM orders
UNION ALL SELECT 'control lineitem', NULL, max(l_shipdate) FROM lineitem""",
)
def _run_extracts(t: Tables) -> DataFrame:
    """A first run on what the tables held by a day, a run on the rest, and that run once more."""
    control, landing = t.scratch("control"), t.scratch("landing")
    times = {"orders": "o_orderdate", "lineitem": "l_shipdate"}

    def until(day: str | None):
        def read(table: str) -> DataFrame:
            rows = getattr(t, table)
            return rows if day is None else rows.where(F.col(times[table]) <= F.lit(day).cast("timestamp_ntz"))

        return read

    run_extracts(t.spark, until("1997-06-01"), times, control, landing, "first")
    for _ in range(2):
        run_extracts(t.spark, until(None), times, control, landing, "second")
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
    parts = [
        landed_rows(VersionedTable(t.spark, control), name).select(
            F.lit(name).alias("kind"), F.col(keys[name]).cast("bigint").alias("id"), F.col(ts).alias("at")
        )
        for name, ts in times.items()
    ]
    marks = control_of(VersionedTable(t.spark, control)).select(
        F.concat(F.lit("control "), "table_name").alias("kind"), F.lit(None).cast("bigint").alias("id"), F.col("run_time").alias("at")
    )
    return parts[0].unionByName(parts[1]).unionByName(marks)


@query(
    "extract_after_failure",
    """
SELECT 'orders' AS kind, CAST(o_orderkey AS BIGINT) AS id, o_orderdate AS at FROM orders
UNION ALL SELECT 'lineitem', l_orderkey, l_shipdate FROM lineitem
UNION ALL SELECT 'rows of orders', count(*), max(o_orderdate) FROM orders
UNION ALL SELECT 'rows of lineitem', count(*), max(l_shipdate) FROM lineitem""",
)
def _extract_after_failure(t: Tables) -> DataFrame:
    """A run, one that fails once it has landed orders, and a third one under a new id."""
    control, landing = VersionedTable(t.spark, t.scratch("control")), t.scratch("landing")
    times = {"orders": "o_orderdate", "lineitem": "l_shipdate"}
    day = F.lit("1997-06-01").cast("timestamp_ntz")

    def reader(table: str) -> DataFrame:
        return getattr(t, table)

    args = (control.path, landing)
    run_extracts(t.spark, lambda table: reader(table).where(F.col(times[table]) <= day), times, *args, "first")
    try:
        run_extracts(t.spark, reader, {**times, "missing": "at"}, *args, "second", workers=1)
    except AttributeError:
        run_extracts(t.spark, reader, times, *args, "third")
    vacuum_landing(control, landing)
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
    found = ledger_of(control).groupBy("table_name").agg(F.sum("rows").alias("id"), F.max("run_time").alias("at"))
    found = found.select(F.concat(F.lit("rows of "), "table_name").alias("kind"), "id", "at")
    for name, ts in times.items():
        landed = landed_rows(control, name)
        found = found.unionByName(landed.select(F.lit(name).alias("kind"), F.col(keys[name]).cast("bigint").alias("id"), F.col(ts).alias("at")))
    return found


@query(
    "rowkey_cells",
    " UNION ALL ".join(
        f"SELECT CAST(o_orderkey AS VARCHAR) AS rowkey, 'CF1' AS family, '{column}' AS qualifier, {text} AS value FROM orders"
        for column, text in (
            ("o_custkey", "CAST(o_custkey AS VARCHAR)"),
            ("o_orderstatus", "o_orderstatus"),
            ("o_totalprice", "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"),
            ("o_orderdate", "CAST(o_orderdate AS VARCHAR)"),
            ("o_orderpriority", "o_orderpriority"),
        )
    ),
)
def _rowkey_cells(t: Tables) -> DataFrame:
    return to_cells(t.orders.withColumn("o_totalprice", money(F.col("o_totalprice"))), ORDER_KEY)


@query(
    "rowkey_composite",
    """SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS rowkey, 'CF1' AS family,
       'l_returnflag' AS qualifier, l_returnflag AS value FROM lineitem""",
)
def _rowkey_composite(t: Tables) -> DataFrame:
    return to_cells(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"), ["l_orderkey", "l_linenumber"])


@query("ensure_table", _ALL_ORDERS_SQL)
def _ensure_table(t: Tables) -> DataFrame:
    """Created once, kept by the second call, emptied, filled."""
    name = f"{t.database()}.orders_final"
    ensure_table(t.spark, name, t.orders.schema)
    append_rows(t.orders, name)
    ensure_table(t.spark, name, t.orders.schema)
    truncate_table(t.spark, name)
    append_rows(t.orders, name)
    return t.spark.table(name)


@query(
    "append_union",
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def _append_union(t: Tables) -> DataFrame:
    name = f"{t.database()}.parties"
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    ensure_table(t.spark, name, customers.schema)
    append_rows(customers, name)
    append_rows(t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")), name)
    return t.spark.table(name)


@query("full_load", _ALL_ORDERS_SQL)
def _full_load(t: Tables) -> DataFrame:
    """Loaded twice: the second load replaces the first."""
    name = f"{t.database()}.orders_final"
    full_load(t.orders, name)
    full_load(t.orders, name)
    return t.spark.table(name)


@query("publish_swap", ORDER_MERGE_SQL)
def _publish_swap(t: Tables) -> DataFrame:
    database = t.database()
    final, staging = f"{database}.orders_final", f"{database}.orders_stg"
    full_load(t.orders, final)
    drop_table(t.spark, staging)
    merged = merge_changes(t.spark.table(final), order_changes(t), ORDER_KEY, tiebreak=ORDER_TIEBREAK)
    save_table(merged, staging)
    publish_swap(t.spark, staging, final)
    return t.spark.table(final)


@query("merge_cobucketed", ORDER_MERGE_SQL)
def _merge_cobucketed(t: Tables) -> DataFrame:
    """The final table is bucketed by its key, so merge and write exchange the changes only."""
    database, buckets = t.database(), bucket_count(t.orders)
    final, staging = f"{database}.orders_final", f"{database}.orders_stg"
    full_load(t.orders, final, ORDER_KEY, buckets)
    merged = merge_changes(t.spark.table(final), order_changes(t), ORDER_KEY, tiebreak=ORDER_TIEBREAK, form="join", unique_base=True, key_partitioned=True)
    save_table(merged, staging, ORDER_KEY, buckets, placed=True)
    publish_swap(t.spark, staging, final)
    return t.spark.table(final)


@query("publish_version", ORDER_MERGE_SQL)
def _publish_version(t: Tables) -> DataFrame:
    table = VersionedTable(t.spark, t.scratch("versions"))
    table.publish(t.orders)
    table.publish(merge_changes(table.read(), order_changes(t), ORDER_KEY, tiebreak=ORDER_TIEBREAK))
    return table.read()


@query(
    "audit_counts",
    " UNION ALL ".join(f"SELECT '{name}' AS tablename, count(*) AS count FROM {name}" for name in TABLES),
)
def _audit_counts(t: Tables) -> DataFrame:
    """Recorded twice; the newest count of a table is the valid one."""
    path = t.scratch("audit")
    tables = {name: getattr(t, name) for name in TABLES}
    first = count_rows(tables, F.lit("2024-01-01").cast("timestamp_ntz"))
    record_counts(first.withColumn("count", F.lit(0).cast("bigint")), path)
    record_counts(count_rows(tables), path)
    return latest_counts(t.spark, path)


@query(
    "run_all_tables",
    f"""
SELECT 'count of orders' AS tablename, count(*) AS id, CAST(NULL AS DOUBLE) AS amount FROM ({ORDER_MERGE_SQL}) AS m
UNION ALL SELECT 'count of customer', count(*), NULL FROM customer
UNION ALL SELECT 'count of part', count(*), NULL FROM part
UNION ALL SELECT 'count of supplier', count(*), NULL FROM supplier
UNION ALL SELECT 'orders', o_orderkey, o_totalprice FROM ({ORDER_MERGE_SQL}) AS m
UNION ALL SELECT 'customer', c_custkey, c_acctbal FROM customer
UNION ALL SELECT 'part', p_partkey, p_retailprice FROM part
UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier""",
)
def _run_all_tables(t: Tables) -> DataFrame:
    """Full loads of four tables, then an incremental load of the one that has changes."""
    root, audit = t.scratch("warehouse"), t.scratch("audit")
    names = ("orders", "customer", "part", "supplier")
    metas = {n: meta_of(n, getattr(t, n).schema, TABLE_KEYS[n]) for n in names}
    specs = [
        LoadSpec.from_metadata(m, tiebreak=ORDER_TIEBREAK if n == "orders" else ()) for n, m in metas.items()
    ]
    run_all(t.spark, specs, run_full, {n: getattr(t, n) for n in names}, root, audit)
    run_all(t.spark, specs, run_incremental, {"orders": order_changes(t)}, root, audit)
    amounts = {"orders": "o_totalprice", "customer": "c_acctbal", "part": "p_retailprice", "supplier": "s_acctbal"}
    found = latest_counts(t.spark, audit).select(
        F.concat(F.lit("count of "), "tablename").alias("tablename"), F.col("count").alias("id"), F.lit(None).cast("double").alias("amount")
    )
    for name in names:
        rows = VersionedTable(t.spark, f"{root}/{name}").read()
        found = found.unionByName(rows.select(F.lit(name).alias("tablename"), F.col(TABLE_KEYS[name][0]).alias("id"), F.col(amounts[name]).alias("amount")))
    return found


@query(
    "inline_values",
    f"""SELECT {', '.join(ORDER_COLUMNS)}, status_id, status_name FROM orders JOIN (
  VALUES (1, 'F', 'Confirmed'), (2, 'O', 'Tentative'), (3, 'P', 'Arrived')
) AS s(status_id, o_orderstatus, status_name) USING (o_orderstatus)""",
)
def _inline_values(t: Tables) -> DataFrame:
    rows = [(1, "F", "Confirmed"), (2, "O", "Tentative"), (3, "P", "Arrived")]
    status = inline_rows(t.spark, rows, "status_id int, o_orderstatus string, status_name string")
    return t.orders.join(status, "o_orderstatus").select(*ORDER_COLUMNS, "status_id", "status_name")


# Change lines of (k, v) made of the order lines; all but the first lines of an order are spoilt in one way.
_PAIR_META = TableMeta("pair", (Field("k", "bigint", True), Field("v", "varchar", False)))
_SPOILT = {2: "number of fields", 3: "number of fields", 4: "malformed field", 5: "missing value", 6: "missing value", 7: "missing value"}


def _write_spoilt_changes(t: Tables, path: str) -> None:
    line = F.col("l_linenumber")
    key = F.col("l_orderkey").cast("string")
    fields = [
        F.concat_ws("-", key, line.cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")),
        *[F.lit("0")] * 3,
        F.when(line == 6, "\\N").otherwise("UPDATE"),
        F.lpad(F.col("l_partkey").cast("string"), 12, "0"),
        F.when(line == 7, "\\N").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")),
        F.when(line == 4, F.concat(F.lit("no. "), key)).when(line == 5, "\\N").otherwise(key),
    ]
    last = F.when(line == 2, "").when(line == 3, ",a,b").otherwise(F.concat(F.lit(","), "l_returnflag", "l_linestatus"))
    t.lineitem.select(F.concat(F.concat_ws(",", *fields), last).alias("value")).write.text(path)


@query(
    "changes_rejects",
    f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
           || '-' || CAST(l_suppkey AS VARCHAR) AS h0,
       CASE {' '.join(f"WHEN l_linenumber = {n} THEN '{reason}'" for n, reason in _SPOILT.items())} END AS reason
FROM lineitem WHERE l_linenumber > 1""",
)
def _changes_rejects(t: Tables) -> DataFrame:
    path = t.scratch("spoilt")
    _write_spoilt_changes(t, path)
    return read_changes_checked(t.spark, path, _PAIR_META)[1].select("h0", "reason")


@query(
    "changes_checked_merge",
    """
SELECT k, v FROM (
  SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY ts DESC, h5 DESC NULLS LAST, v DESC) AS rnk
  FROM (
    SELECT o_orderkey AS k, o_orderstatus AS v, TIMESTAMP '1900-01-01' AS ts, NULL AS h5 FROM orders
    UNION ALL
    SELECT l_orderkey, l_returnflag || l_linestatus, l_shipdate, lpad(CAST(l_partkey AS VARCHAR), 12, '0')
    FROM lineitem WHERE l_linenumber = 1
  ) AS u
) AS r WHERE rnk = 1""",
)
def _changes_checked_merge(t: Tables) -> DataFrame:
    path = t.scratch("spoilt")
    _write_spoilt_changes(t, path)
    base = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"))
    return merge_changes(base, read_changes(t.spark, path, _PAIR_META), ["k"], tiebreak=["h5", "v"])


def _catalog(t: Tables, keys: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Catalog views as a source database shows them, made of the given tables' schemas."""
    metas = [meta_of(name, getattr(t, name).schema, key) for name, key in keys.items()]
    types = sorted({f.data_type for m in metas for f in m.fields})
    columns, members = [], []
    for object_id, meta in enumerate(metas):
        for column_id, f in enumerate(meta.fields):
            columns.append((object_id, column_id, types.index(f.data_type), f.name))
            if f.is_primary:
                members.append((object_id, column_id, 1))
    return {
        "tables": inline_rows(t.spark, [(i, m.table) for i, m in enumerate(metas)], "object_id int, table_name string"),
        "columns": inline_rows(t.spark, columns, "object_id int, column_id int, user_type_id int, column_name string"),
        "types": inline_rows(t.spark, list(enumerate(types)), "user_type_id int, type_name string"),
        "index_columns": inline_rows(t.spark, members, "object_id int, column_id int, index_id int"),
        "indexes": inline_rows(
            t.spark, [(i, 1, True) for i in range(len(metas))], "object_id int, index_id int, is_primary_key boolean"
        ),
    }


@query(
    "discover_to_load",
    f"""
SELECT 'orders' AS tablename, o_orderkey AS id, o_totalprice AS amount FROM ({ORDER_MERGE_SQL}) AS m
UNION ALL SELECT 'customer', c_custkey, c_acctbal FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier""",
)
def _discover_to_load(t: Tables) -> DataFrame:
    """From catalog rows to metadata files, full loads, and two cycles of change files of the orders."""
    keys = {name: TABLE_KEYS[name] for name in ("orders", "customer", "supplier")}
    catalog = _catalog(t, keys)
    metadata, root, folder, archive = (t.scratch(x) for x in ("metadata", "warehouse", "change-files", "archive"))
    write_metadata(discover_tables(**catalog), metadata)
    loaded = load_discovered(
        t.spark, read_metadata(t.spark, metadata), lambda name: getattr(t, name), root, t.scratch("audit"),
        {"orders": {"tiebreak": CHANGE_FILE_TIEBREAK}},
    )
    spec, meta = loaded["orders"]
    changes = order_change_rows(t).select(*CHANGE_HEADER, *[f.name for f in meta.fields])
    day = F.lit("1997-01-01").cast("timestamp_ntz")
    for part in (changes.where(F.col(TIMESTAMP) < day), changes.where(F.col(TIMESTAMP) >= day)):
        write_snapshot(part, folder, mode="append")
        for _ in range(2):  # the second cycle finds nothing
            run_change_files(t.spark, spec, meta, folder, archive, root)
    amounts = {"orders": "o_totalprice", "customer": "c_acctbal", "supplier": "s_acctbal"}
    found = None
    for name, amount in amounts.items():
        rows = VersionedTable(t.spark, f"{root}/{name}").read()
        rows = rows.select(F.lit(name).alias("tablename"), F.col(keys[name][0]).alias("id"), F.col(amount).alias("amount"))
        found = rows if found is None else found.unionByName(rows)
    return found


@query("merge_touched_files", ORDER_MERGE_SQL)
def _merge_touched_files(t: Tables) -> DataFrame:
    """Changes of the lower half of the keys, which leave the files of the upper half alone, then the others."""
    table = RangedTable(t.spark, t.scratch("ranged"), ORDER_KEY)
    table.create(t.orders, files=16)
    changes, middle = order_changes(t), t.orders.agg(F.avg("o_orderkey")).first()[0]
    for part in (changes.where(F.col("o_orderkey") < middle), changes.where(F.col("o_orderkey") >= middle)):
        table.merge(part, tiebreak=ORDER_TIEBREAK)
    return table.read().select(*ORDER_COLUMNS)


class _Broken(ChangeCycles):
    """Cycles that break off before or after the commit."""

    after = False

    def _commit(self, changes: DataFrame, cycle: str) -> None:
        if self.after:
            super()._commit(changes, cycle)
        raise InterruptedError


@query(
    "change_cycle_resumed",
    """
SELECT k, v, NULL AS reason FROM (
  SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY ts DESC, h5 DESC NULLS LAST, v DESC) AS rnk
  FROM (
    SELECT o_orderkey AS k, o_orderstatus AS v, TIMESTAMP '1900-01-01' AS ts, NULL AS h5 FROM orders
    UNION ALL
    SELECT l_orderkey, l_returnflag || l_linestatus, l_shipdate, lpad(CAST(l_partkey AS VARCHAR), 12, '0')
    FROM lineitem WHERE l_linenumber = 1
  ) AS u
) AS r WHERE rnk = 1
UNION ALL
SELECT count(*), NULL, CASE WHEN l_linenumber < 4 THEN 'number of fields' WHEN l_linenumber = 4 THEN 'malformed field'
  ELSE 'missing value' END FROM lineitem WHERE l_linenumber > 1 GROUP BY 3""",
)
def _change_cycle_resumed(t: Tables) -> DataFrame:
    """A cycle that breaks off before its commit, one after it, and the run that follows; good and rejected rows count once."""
    spec = LoadSpec.from_metadata(_PAIR_META, tiebreak=("h5", "v"))
    root, folder, archive = (t.scratch(x) for x in ("warehouse", "change-files", "archive"))
    run_full_ranged(spec, t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v")), root)
    _write_spoilt_changes(t, folder)
    for after in (False, True):
        broken = _Broken(t.spark, spec, _PAIR_META, root, ranged=True)
        broken.after = after
        try:
            broken.run(folder, archive)
        except InterruptedError:
            pass
    cycles = ChangeCycles(t.spark, spec, _PAIR_META, root, ranged=True)
    cycles.run(folder, archive)
    rejected = cycles.rejects().groupBy("reason").agg(F.count(F.lit(1)).alias("k"))
    return cycles.table.read().select("k", "v", F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select("k", F.lit(None).cast("string").alias("v"), "reason")
    )


@query(
    "audit_observed",
    " UNION ALL ".join(
        f"SELECT '{name}' AS tablename, count(*) AS count FROM " + (f"({ORDER_MERGE_SQL}) AS m" if name == "orders" else name)
        for name in TABLE_KEYS
    ),
)
def _audit_observed(t: Tables) -> DataFrame:
    """Full loads of all keyed tables, then changes of the orders; the counts are those of the tasks that wrote the tables."""
    root, audit = t.scratch("warehouse"), t.scratch("audit")
    metas = {n: meta_of(n, getattr(t, n).schema, k) for n, k in TABLE_KEYS.items()}
    specs = [LoadSpec.from_metadata(m, tiebreak=ORDER_TIEBREAK if n == "orders" else ()) for n, m in metas.items()]
    by_range = [s for s in specs if s.table == "orders"]
    run_all(t.spark, [s for s in specs if s.table != "orders"], run_full, {n: getattr(t, n) for n in metas}, root, audit)
    run_all(t.spark, by_range, run_full_ranged, {"orders": t.orders}, root, audit)
    run_all(t.spark, by_range, run_incremental_ranged, {"orders": order_changes(t)}, root, audit)
    return latest_counts(t.spark, audit)


def skewed_lines(t: Tables) -> DataFrame:
    """Lines with a key that a large share of them has in common, and some have none."""
    number = F.col("l_linenumber")
    key = F.when(number == 1, 1).when(number == 7, None).otherwise(F.col("l_suppkey"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", key.alias("split_key"))


@query(
    "extract_split",
    """SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_linenumber = 1 THEN 1 WHEN l_linenumber = 7 THEN NULL ELSE l_suppkey END AS split_key FROM lineitem""",
)
def _extract_split(t: Tables) -> DataFrame:
    """Read range by range of the key; the reads of the hot key's rows are dealt by the order."""
    lines = skewed_lines(t)
    return read_split(lines, balanced_predicates(lines, "split_key", 8, spread="l_orderkey", sample_rows=20_000))


@query(
    "cells_written",
    " UNION ALL ".join(
        f"SELECT CAST(o_orderkey AS VARCHAR) AS rowkey, 'CF1' AS family, '{column}' AS qualifier, {text} AS value FROM ({ORDER_MERGE_SQL}) AS m"
        for column, text in (
            ("o_custkey", "CAST(o_custkey AS VARCHAR)"),
            ("o_orderstatus", "o_orderstatus"),
            ("o_totalprice", "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"),
            ("o_orderdate", "CAST(o_orderdate AS VARCHAR)"),
            ("o_orderpriority", "o_orderpriority"),
        )
    ),
)
def _cells_written(t: Tables) -> DataFrame:
    """The orders put into a store of cells, then the newest change of each as a put or a delete, sent twice under one id."""
    store = FileCells(t.scratch("cells"))
    price = money(F.col("o_totalprice"))
    write_mutations(to_mutations(t.orders.select(*ORDER_COLUMNS).withColumn("o_totalprice", price), ORDER_KEY), store)
    newest = compact_changes(order_changes(t), ORDER_KEY, ORDER_COLUMNS, tiebreak=ORDER_TIEBREAK)
    newest = newest.select(*ORDER_COLUMNS, "_op").withColumn("o_totalprice", price)
    changes = to_mutations(newest, [*ORDER_KEY, "_op"], F.col("_op") == DELETE)
    changes = changes.withColumn("rowkey", F.substring_index("rowkey", "_", 1))
    for _ in range(2):
        write_mutations(changes, store, "changes")
    return store.read(t.spark)
