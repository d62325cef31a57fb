"""RP-21: the monthly report — every report of the month written under one folder.

The input tables are read once each, into stage tables in the session's shared
checkpoint folder, and all reports read those: they show one state of the
data, however long the run takes or whatever changes meanwhile, and a source
that is slow to read is read once. The commission detail feeds two dashboards
and is a stage table of its own. Each report is one parquet sub-folder,
written with ``overwrite`` so a rerun (or a retried task) replaces it whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from ledgerly.plans import registry
from ledgerly.session import checkpoint_dir, cut_lineage
from ledgerly.sources.tables import table

REPORTS = ["commission_dashboard", "paid_dashboard", "commission_view", "teacher_balances", "student_balances", "statement_lines",
           "daily_cash", "club_projection", "operations_kpis", "kpi_history", "revenue_class",
           "payment_breakdown", "mix_vs_target", "court_occupancy", "goals", "cash_flow_statement", "cash_flow_months",
           "income_statement", "daily_projection", "month_projection", "payables", "teacher_table", "cash_reconciliation",
           "hourly_rate_vs_plan", "mix_history", "bracket_tax", "roi", "audit_list"]
#: The tables that the reports read.
INPUTS = ["nation", "customer", "part", "orders", "lineitem", "events"]


def stage_inputs(spark: SparkSession, sf_dir: str, names=INPUTS) -> str:
    """Copy the input tables to the shared folder, each in one scan; the folder to read instead."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/report-{uuid.uuid4().hex}"
    for n in names:
        table(spark, sf_dir, n).write.parquet(f"{folder}/{n}.parquet")
    return folder


def monthly_report(spark: SparkSession, sf_dir: str, out_dir: str, names=REPORTS) -> dict[str, str]:
    """Write each report to ``out_dir/<name>``; returns name -> path."""
    from ledgerly.plans import q_alloc, q_dashboard
    registry.load_all()
    detail, out, staged = None, {}, stage_inputs(spark, sf_dir)
    for n in names:
        path = f"{out_dir.rstrip('/')}/{n}"
        if n in ("commission_dashboard", "paid_dashboard"):
            if detail is None:
                detail = cut_lineage(q_alloc.commission_detail(spark, staged))
            col = "booking_date" if n == "commission_dashboard" else "pay_date"
            df = q_dashboard._dash(q_dashboard.paid_rows(detail, q_dashboard.DASH_MONTH, col))
        else:
            df = registry.QUERIES[n](spark, staged)
        df.write.mode("overwrite").parquet(path)
        out[n] = path
    return out
