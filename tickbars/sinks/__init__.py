"""Keyed result tables, message output and optional external stores."""
