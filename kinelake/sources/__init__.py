"""Table and file sources."""

from kinelake.sources.tables import read_table

__all__ = ["read_table"]
