"""Operators for preparing training text: language, near copies, decontamination, tokens and more."""
