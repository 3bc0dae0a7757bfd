"""Sources and sinks (A1-A15) and the driver's test tables."""

from diffloom.sources.tables import TABLES, load_table, load_tables  # noqa: F401
