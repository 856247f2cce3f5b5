"""Catalogs, envelopes and stage tables."""
