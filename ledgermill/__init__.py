"""Spark-native analytics for financial data: layers, rules, alerts, graphs, streams."""
