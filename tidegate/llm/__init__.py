"""Operators for preparing training text: archives, cleaning, de-duplication, packing."""
