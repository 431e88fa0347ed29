"""Readers: driver tables, the derived event log, snapshot scans and file sources."""
