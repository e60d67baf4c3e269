"""Tick and daily-bar analytics as plain Spark DataFrame operators.

Every operator takes a DataFrame and returns a DataFrame; the same function serves a static table and, wherever Spark
allows the plan on a stream, a streaming one. Sources and sinks sit at the edges, and nothing here picks a master.
"""
