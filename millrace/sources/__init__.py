from millrace.sources.landing import LandingMissing, SourceSpec, read_landing
from millrace.sources.tables import TableMissing, ParquetTable

__all__ = ["LandingMissing", "SourceSpec", "TableMissing", "ParquetTable", "read_landing"]
