"""Spark jobs over positioned payslip words: rows, layouts, fields, checks, tables, reports."""
