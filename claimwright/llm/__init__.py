"""Operators for preparing training data: archives, duplicates, languages, mixing, cleaning."""
