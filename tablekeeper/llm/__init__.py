"""Operators for preparing training text: filters, duplicates, language, licences, mixing and tokens."""
