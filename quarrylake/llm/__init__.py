"""Operators for large text and matching corpora; nothing outside this folder imports it."""
