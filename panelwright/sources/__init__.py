"""Readers, writers, fixed lookup relations and model storage."""
