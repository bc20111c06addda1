"""Readers, bounded and streaming."""
