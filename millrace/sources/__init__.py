"""Readers, writers and the retail / clickstream views."""
