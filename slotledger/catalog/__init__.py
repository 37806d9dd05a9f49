"""Every operator as a named query over the driver's tables, beside the SQL it must equal."""

from slotledger.catalog import ingest, marts, reports, scalars  # noqa: F401  (they register themselves)
from slotledger.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
