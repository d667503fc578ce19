"""Spark-native siting analytics: catalogues, telemetry, hex grids, allocation and candidate sites."""
