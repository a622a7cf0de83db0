"""Scans and sinks: driver tables, raw CSV zone, landing, manifests."""
