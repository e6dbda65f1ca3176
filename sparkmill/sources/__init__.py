"""Readers (explicit schemas, no inference) and writers."""
