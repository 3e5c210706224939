"""Registration of named queries and the shared SQL views their oracles start from."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

# Views written in plain SQL against the given tables, independent of the DataFrame code.
VIEWS: dict[str, str] = {
    "raw": """
        SELECT CAST(event_id AS VARCHAR) AS event_id,
               'user_' || user_id AS user_id,
               'item_' || json_extract_string(props, '$.k') AS item_id,
               CASE event_type WHEN 'purchase' THEN 'rating' ELSE event_type END AS event_type,
               CASE WHEN event_type = 'purchase'
                    THEN CAST(1.0 AS DOUBLE) + CAST(0.5 AS DOUBLE) * (event_id % 9) END AS rating,
               ts,
               'cat_' || (CAST(json_extract_string(props, '$.k') AS BIGINT) % 10) AS category
        FROM events""",
    "ev": "SELECT * FROM raw WHERE event_type IN ('view', 'click', 'rating')",
    "li": """
        SELECT 'user_' || o_custkey AS user_id, 'item_' || l_partkey AS item_id,
               CASE l_returnflag WHEN 'N' THEN 'view' WHEN 'A' THEN 'click' ELSE 'rating' END AS event_type,
               CASE WHEN l_returnflag NOT IN ('N', 'A')
                    THEN CAST(1.0 AS DOUBLE) + CAST(0.5 AS DOUBLE) * (CAST(l_quantity AS INTEGER) % 9) END AS rating,
               l_shipdate AS ts, p_type AS category, p_brand AS brand
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
}

_NEEDS = {"ev": ("raw", "ev")}


def with_views(views: str, body: str, recursive: bool = False) -> str:
    """Prefix ``body`` (its own CTEs and final SELECT) with the named shared views."""
    names: list[str] = []
    for v in views.split():
        for n in _NEEDS.get(v, (v,)):
            if n not in names:
                names.append(n)
    heads = [f"{n} AS ({VIEWS[n].strip()})" for n in names]
    text = body.strip()
    if text.upper().startswith("WITH "):
        text = ",\n" + text[5:]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(heads) + "\n" + text


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query; times are computed in UTC so both engines see the same hours and days."""
    def add(fn: QueryFn) -> QueryFn:
        @functools.wraps(fn)
        def run(spark: SparkSession, root: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, root)
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return add


def load_all() -> None:
    """Import every plan module once; importing registers its queries."""
    from rillmark.plans import catalog  # noqa: F401
