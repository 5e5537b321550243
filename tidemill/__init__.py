"""Retail log and change-log analytics as Spark DataFrame functions."""
