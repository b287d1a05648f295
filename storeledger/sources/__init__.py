"""Readers. Paths and JDBC options come from the caller."""
