"""caseflux: a PySpark-native analytics engine for incident and event data."""

__version__ = "0.1.0"
