from martforge.sources.base import (
    CatalogSources, FrameSources, ParquetSources, Sources, scope_client, scope_language,
)
from martforge.sources.shape import DriverSources

__all__ = ["CatalogSources", "DriverSources", "FrameSources", "ParquetSources", "Sources", "scope_client", "scope_language"]
