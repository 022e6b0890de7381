"""Readers of the tables and of word lists, ledgers, caches and counts in files."""
