"""Queries over ledgers, review decisions and the folder watcher."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.operators import ledger
from rowmill.operators.validate import validate
from rowmill.plans.catalog import query
from rowmill.plans.feed import table
from rowmill.operators.joins import lookup
from rowmill.session import scratch_path
from rowmill.streaming.watch import watch_folder


def _files(spark, sf_dir):
    """Orders as a file ledger: F done, O and P open."""
    return table(spark, sf_dir, "orders").select(
        F.sha2(F.col("o_orderkey").cast("string"), 256).alias("file_id"),
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        F.when(F.col("o_orderstatus") == "F", "success").otherwise("processing").alias("status"),
    )


@query(
    "skip_processed",
    "SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS file_id, o_orderkey FROM orders WHERE o_orderstatus <> 'F'",
)
def _skip_processed(spark, sf_dir):
    files = _files(spark, sf_dir)
    return ledger.skip_processed(files.select("file_id", "o_orderkey"), files)


@query("files_by_status", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def _files_by_status(spark, sf_dir):
    return _files(spark, sf_dir).where("status = 'success'").select("o_orderkey")


@query(
    "latest_version",
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (
         PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def _latest_version(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    return ledger.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "effective_decision",
    """WITH d AS (SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'approved' ELSE 'rejected' END AS decision,
           l_suppkey, l_shipdate, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC,
             CAST(l_suppkey AS VARCHAR) DESC, l_returnflag = 'A', l_linenumber) AS rn FROM lineitem)
        SELECT o_orderkey AS row_id, coalesce(decision, 'flagged') AS effective_status,
          CAST(l_suppkey AS VARCHAR) AS approved_by FROM orders LEFT JOIN d ON o_orderkey = l_orderkey AND rn = 1""",
)
def _effective_decision(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.lit("flagged").alias("status")
    )
    decisions = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("row_id"),
        F.when(F.col("l_returnflag") == "A", "approved").otherwise("rejected").alias("decision"),
        F.col("l_suppkey").cast("string").alias("reviewer_id"),
        F.col("l_shipdate").alias("decided_at"),
    )
    return ledger.effective_status(rows, decisions).select("row_id", "effective_status", "approved_by")


@query(
    "orphan_check",
    """SELECT doc_id, count(*) AS n_rows FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id""",
)
def _orphan_check(spark, sf_dir):
    return ledger.orphan_keys(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id"
    )


@query(
    "batch_rows",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
       WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1997)""",
)
def _batch_rows(spark, sf_dir):
    """Rows of the files of a batch; a batch is a year of orders."""
    files = table(spark, sf_dir, "orders").where(F.year("o_orderdate") == 1997)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    named = rows.withColumn("file_id", F.col("l_orderkey"))
    return ledger.rows_of_files(named, files.select(F.col("o_orderkey").alias("file_id"))).drop("file_id")


@query(
    "current_rows",
    """WITH f AS (SELECT o_custkey, max(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
        SELECT o_custkey, o_orderkey, o_totalprice FROM orders JOIN f USING (o_custkey) WHERE o_orderkey = k""",
)
def _current_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    versions = orders.select(
        F.col("o_custkey").alias("file_id"),
        F.col("o_orderkey").alias("batch_id"),
        F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed").alias("status"),
        F.col("o_orderkey").alias("recorded_at"),
    )
    rows = orders.select(
        F.col("o_custkey").alias("file_id"), F.col("o_orderkey").alias("batch_id"), "o_totalprice"
    )
    return ledger.current_rows(rows, versions).select(
        F.col("file_id").alias("o_custkey"), F.col("batch_id").alias("o_orderkey"), "o_totalprice"
    )


@query(
    "lookup_join",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey",
)
def _lookup_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return lookup(lines, names, ["l_suppkey"])


@query(
    "stream_intake_equals_batch",
    """SELECT event_id, event_type, CASE WHEN value < 20 OR event_type = 'error' THEN 'flagged' ELSE 'valid' END AS status
       FROM events""",
)
def _stream_intake(spark, sf_dir):
    """The events file through the folder watcher, validated per micro-batch."""
    rules = {
        "field_validation_rules": [
            {"field": "value", "rule_type": "range", "min_value": 20},
            {"field": "event_type", "rule_type": "enum", "values": ["click", "view", "purchase", "signup"]},
        ]
    }
    events = table(spark, sf_dir, "events")
    kinds = events.select("event_type").distinct()
    known = [r.event_type for r in kinds.collect() if r.event_type != "error"]
    rules["field_validation_rules"][1]["values"] = known
    out = scratch_path(spark, "stream")
    watch_folder(
        spark,
        f"{sf_dir}/events.parq*",
        events.schema,
        lambda df: validate(df, rules),
        f"{out}/rows",
        f"{out}/checkpoint",
    ).awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("event_id", "event_type", "status")


@query(
    "ledger_lookups",
    """WITH r AS (SELECT 'r' || o_orderkey AS row_id, 'f' || (o_custkey % 20) AS file_id, o_custkey % 20 AS k, o_orderstatus FROM orders)
       SELECT DISTINCT 'failed file' AS what, file_id AS id FROM r WHERE k % 3 = 0
       UNION ALL SELECT 'row of f4', row_id FROM r WHERE file_id = 'f4'
       UNION ALL SELECT 'row r1', row_id FROM r WHERE row_id = 'r1' AND k % 3 <> 0
       UNION ALL SELECT 'batch', 'running then success'
       UNION ALL SELECT 'approved', row_id FROM r WHERE k % 3 <> 0 AND o_orderstatus = 'P'""",
)
def _ledger_lookups(spark, sf_dir):
    """Orders as the rows of twenty files: looked up by status, file, row, batch and decision."""
    state = ledger.Ledger(spark, scratch_path(spark, "lookups"))
    k = F.col("o_custkey") % 20
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey", k.cast("string").alias("k"))
    file_id = F.concat(F.lit("f"), "k").alias("file_id")

    def filled(df, schema):
        """The columns of a ledger table, null where there is nothing."""
        kinds = spark.createDataFrame([], schema).dtypes
        return df.select(*[F.col(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in kinds])

    now = F.current_timestamp()
    rows = orders.select(
        F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("row_id"), file_id,
        F.col("o_orderkey").alias("line_number"), F.lit("flagged").alias("status"), F.lit("b1").alias("batch_id"), "o_orderstatus",
    )
    state.append("rows", filled(rows.drop("o_orderstatus"), ledger.ROWS), "batch_id")
    status = F.when(F.col("k").cast("int") % 3 == 0, "failed").otherwise("success").alias("status")
    state.append("files", filled(orders.select(file_id, status, F.lit("b1").alias("batch_id"), now.alias("recorded_at")).distinct(), ledger.FILES))
    for at, mark in enumerate(("running", "success")):
        record = spark.range(1).select(
            F.lit("b1").alias("batch_id"), F.lit(mark).alias("status"), F.timestamp_seconds(F.lit(at)).alias("recorded_at")
        )
        state.append("batches", filled(record, ledger.BATCHES))
    state.approve_rows(rows.where("o_orderstatus = 'P'").select("row_id"), "ann")
    found = [
        state.files_by_status("failed").select(F.lit("failed file").alias("what"), F.col("file_id").alias("id")),
        state.rows_by_file("f4").select(F.lit("row of f4"), "row_id"),
        state.row("r1").select(F.lit("row r1"), "row_id"),
        state.batch("b1").select(F.lit("batch"), F.concat(F.lit("running then "), "status")),
        state.reviewed_rows().where("effective_status = 'approved'").select(F.lit("approved"), "row_id"),
    ]
    return reduce(DataFrame.union, found)
