"""Readers: prescribing months, lookups, boundaries, grouped base table, manifests."""
