"""Relational operators over topics, files, tables and schemas."""
