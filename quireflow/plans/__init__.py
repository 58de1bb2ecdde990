"""Composed stages and the catalogue of registered queries."""
