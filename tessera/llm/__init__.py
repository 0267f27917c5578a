"""Operators of a training-data pipeline (optional subpackage; nothing else imports it)."""
