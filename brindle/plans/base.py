"""Registration of queries, and the views that only queries use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.plans.fixtures import VIEWS, view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

View = Callable[[str], DataFrame]

#: "Now" of the due and dashboard queries.
NOW = "2024-01-20 10:30:00"
ZONES = ("Europe/Paris", "America/New_York", "Asia/Tokyo", "UTC")

VIEWS["fx_due_leads"] = f"SELECT *, CASE WHEN lead_id % 4 = 0 THEN NULL ELSE CAST('2024-01-18 00:00:00' AS TIMESTAMP) + INTERVAL '1' HOUR * cast(lead_id % 96 AS int) END AS next_send_at, CAST(NULL AS TIMESTAMP) AS replied_at FROM fx_leads"
VIEWS["fx_requests"] = "SELECT user_id AS lead_id, min(ts) AS ts FROM events WHERE event_type = 'purchase' GROUP BY user_id"
VIEWS["fx_links"] = "SELECT page_id, url, cast(page_id % 3 AS int) AS grp FROM pages"


def query(sql: str | None = None) -> Callable:
    """Registers a function of a view lookup under its name; sql is what DuckDB runs."""

    def add(f: Callable[[View], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: view(spark, sf_dir, name))

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = with_views(" ".join(sql.split("\n")))
        return f

    return add


def now() -> Column:
    return F.lit(NOW).cast("timestamp")
