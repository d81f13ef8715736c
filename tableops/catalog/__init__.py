"""Registered queries: every operator over the test tables, with the same query in SQL."""
