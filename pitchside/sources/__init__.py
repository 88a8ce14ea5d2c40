"""Scans: nested match documents, post responses, stored tables, file manifests."""
