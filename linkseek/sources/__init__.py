"""Readers, writers and corpus adapters."""
