"""The checks job on the benchmark tables, and its SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from litreflow.checks import Check, run_checks
from litreflow.sources.tables import tables_for

# --- fixed values: the checks run on the benchmark tables ------------------
BENCH_CHECKS = [
    Check("orders", "o_orderkey", "not_null"),
    Check("orders", "o_orderkey", "unique"),
    Check("orders", "o_custkey", "not_null"),
    Check("lineitem", "l_orderkey", "relationships", parent="orders", parent_column="o_orderkey"),
    Check("lineitem", "l_orderkey", "unique"),
    Check("lineitem", "l_quantity", "accepted_range", "warn", min_value=0, max_value=50),
    Check("lineitem", "l_quantity", "not_null"),
    Check("lineitem", "l_discount", "accepted_range", "warn", min_value=0.0, max_value=0.05),
    Check("customer", "c_acctbal", "accepted_range", "warn", min_value=0),
    Check("lineitem", "l_shipdate", "accepted_range", "error", min_value="1995-01-01",
          max_value="2000-12-31"),
    Check("labels", "doc_id", "relationships", parent="documents", parent_column="doc_id"),
]
# --- end of fixed values ----------------------------------------------------


def checks_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables_for(spark, sf_dir)
    frames = {name: t.get(name) for name in
              ("orders", "lineitem", "customer", "labels", "documents")}
    return run_checks(BENCH_CHECKS, frames)


def _sql_lit(v) -> str:
    return repr(v) if not isinstance(v, str) else f"'{v}'"


def checks_report_sql() -> str:
    parts = []
    for c in BENCH_CHECKS:
        head = (f"SELECT '{c.model}' AS model, '{c.column}' AS column_name, "
                f"'{c.test}' AS check_name, '{c.severity}' AS severity, ")
        if c.test == "not_null":
            body = f"CAST(count(*) FILTER (WHERE {c.column} IS NULL) AS BIGINT) AS failures FROM {c.model}"
        elif c.test == "accepted_range":
            conds = []
            if c.min_value is not None:
                conds.append(f"{c.column} >= {_sql_lit(c.min_value)}")
            if c.max_value is not None:
                conds.append(f"{c.column} <= {_sql_lit(c.max_value)}")
            body = (f"CAST(count(*) FILTER (WHERE NOT ({' AND '.join(conds)})) AS BIGINT) "
                    f"AS failures FROM {c.model}")
        elif c.test == "unique":
            body = (f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c.column} FROM {c.model} "
                    f"WHERE {c.column} IS NOT NULL GROUP BY {c.column} HAVING count(*) > 1)")
        else:
            body = (f"CAST(count(*) AS BIGINT) AS failures FROM {c.model} ch "
                    f"WHERE ch.{c.column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {c.parent} p "
                    f"WHERE p.{c.parent_column} = ch.{c.column})")
        parts.append(head + body)
    return ("SELECT model, column_name, check_name, severity, failures, failures = 0 AS passed FROM ("
            + "\nUNION ALL\n".join(parts) + ")")
