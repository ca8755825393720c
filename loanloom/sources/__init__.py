"""Readers, writers, schemas and the views the registered queries read."""
