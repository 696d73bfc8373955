"""Readers of landed payloads and files."""
