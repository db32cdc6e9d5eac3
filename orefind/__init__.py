"""A PySpark-native document search engine: collections, full-text, vector and hybrid search, and corpus tools."""
