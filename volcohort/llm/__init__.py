"""Operators for preparing training text at scale; nothing outside this folder imports it."""
