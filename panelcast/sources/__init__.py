"""Sources and sinks."""

from panelcast.sources.tables import read_table

__all__ = ["read_table"]
