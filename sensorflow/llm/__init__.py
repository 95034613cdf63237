"""Operators for preparing training text: quality, duplicates, decontamination, personal data, tokens and more."""
