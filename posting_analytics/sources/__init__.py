"""Sources and sinks: files, document collections, table profile."""

from . import collections, files, profile

__all__ = ["collections", "files", "profile"]
