"""Scans, sinks, load modes and the load ledger."""
