"""Registered queries over the driver's tables, and SQL that restates them."""
