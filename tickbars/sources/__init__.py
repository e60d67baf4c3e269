"""Readers for bars, quotes, ticks and nested payloads."""
