"""Readers, writers and the adapters that shape the driver tables into panels."""
