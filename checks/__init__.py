"""Queries over the TPC-H-like tables and the SQL they are compared with."""
