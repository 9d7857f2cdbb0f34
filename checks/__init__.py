"""Queries over the given test tables, with the SQL that must give the same rows."""
