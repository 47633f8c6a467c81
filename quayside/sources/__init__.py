"""Readers for topics, schema registries and the file catalog."""
