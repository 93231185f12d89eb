"""Retail, event and Spark-workload analytics as plain DataFrame functions."""
