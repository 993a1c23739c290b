"""Operators for preparing training data; see the modules for their methods."""
