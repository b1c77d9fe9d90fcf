"""Registered queries over the driver tables, with SQL to check them."""
