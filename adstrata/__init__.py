"""Spark-native lake for messy job-market data: Bronze, Silver, text extraction, Gold, analytics."""
