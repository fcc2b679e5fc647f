"""Operators for preparing training text at corpus scale (see README, section on training data)."""
