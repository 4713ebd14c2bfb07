"""panelspark: analytics over panels of economic indicators, written for Spark.

A panel is a table ``(series key ..., period, value)`` with one row per series and
period.  Everything here takes DataFrames and returns DataFrames; nothing runs an action
except the stored-table functions in :mod:`panelspark.sources.store` and the loads in
:mod:`panelspark.plans.loads`.
"""

from panelspark.schema import Scope, Tables, TableSpec, TABLES
from panelspark.session import build_session

__all__ = ["Scope", "Tables", "TableSpec", "TABLES", "build_session"]
