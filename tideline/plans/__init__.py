"""Keyed tables, database synchronisation and the registered queries."""
