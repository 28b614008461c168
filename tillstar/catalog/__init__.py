"""Every operator as a runnable query over the test tables, with the SQL it must agree with."""

from tillstar.catalog.base import ORACLES, QUERIES, Context, oracle_text

from tillstar.catalog import (  # noqa: F401  (each module registers its queries)
    scans, relational, scalars, dims, fact_queries, reports, quality_queries, kpi_queries, incremental_queries,
)

__all__ = ["Context", "ORACLES", "QUERIES", "oracle_text"]
