"""Operators for preparing training text, each on whole tables of documents or vectors."""
