"""Checkable queries: every operator on the driver tables, with the SQL it must agree with.

Each module has `QUERIES` (name -> function of session and folder) and `SQL`
(name -> text for DuckDB on the same tables).
"""
