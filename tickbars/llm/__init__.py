"""Operators of a training-data pipeline over documents, pages and conversations. Nothing else imports this package."""
