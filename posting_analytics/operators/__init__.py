"""DataFrame -> DataFrame operators."""

from . import clean, cluster, documents, extract, features, report, tables

__all__ = ["clean", "cluster", "documents", "extract", "features", "report", "tables"]
