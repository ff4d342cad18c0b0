"""Readers and generators of logs, changes, golden sets and question packs."""
