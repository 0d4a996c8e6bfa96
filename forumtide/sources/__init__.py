"""Readers and writers for bundles, artifacts and raw pages."""
