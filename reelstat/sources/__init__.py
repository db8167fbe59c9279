"""Readers for tables, JDBC and text event lines."""
