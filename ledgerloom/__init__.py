"""Purchasing-document analytics as PySpark DataFrame jobs."""
