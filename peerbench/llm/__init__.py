"""Operators of a training-data pipeline: contamination, duplicates, language, quality, links, privacy, mixing."""
