"""Readers. Schemas are declared, never inferred."""
