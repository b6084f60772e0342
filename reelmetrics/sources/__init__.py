"""Readers: wire messages, stored tables, the test tables."""
