"""Every operator as a named query over the driver's tables, with SQL to compare."""

from ontime.catalog.queries import QUERIES
from ontime.catalog.sql import ORACLE

__all__ = ["ORACLE", "QUERIES"]
