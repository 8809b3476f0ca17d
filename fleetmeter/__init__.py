"""Accelerator usage analytics as PySpark DataFrame operators."""
