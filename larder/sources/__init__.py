"""Readers. Every read passes an explicit schema."""
