"""Readers, writers, catalog registration and config-driven ingestion."""
