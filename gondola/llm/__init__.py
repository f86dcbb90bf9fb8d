"""Operators for training corpora: each module one operator, ``queries`` their registration."""
