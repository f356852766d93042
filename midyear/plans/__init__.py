"""Composed pipelines and workbook layouts."""
