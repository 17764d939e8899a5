"""tessera: a PySpark-native batch and streaming analytics engine."""
