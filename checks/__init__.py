"""Queries over the generated test tables, each with the SQL it is checked against."""
