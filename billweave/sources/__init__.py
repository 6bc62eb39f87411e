"""Readers: manifests, file listings and CSV parts."""
