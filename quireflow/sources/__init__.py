"""Readers for scanned documents, images, recognised text and settings."""
