"""Readers, writers and the load job."""
