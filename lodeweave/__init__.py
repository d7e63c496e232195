"""A PySpark-native engine for curating text and conversation corpora."""
