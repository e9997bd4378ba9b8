"""Specifications of tables and the runs that load them."""
