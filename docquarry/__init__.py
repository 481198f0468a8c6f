"""docquarry: a PySpark-native document-evidence and disclosure-index engine."""

__version__ = "0.1.0"
