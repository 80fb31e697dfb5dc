"""Registered queries: the library run over the driver tables, and the SQL to check it."""
