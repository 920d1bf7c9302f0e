"""Operators of a training-data pipeline: scoring, cleaning, tokenising, deduplicating, archiving, searching, mixing."""
