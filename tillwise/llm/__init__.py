"""Operators of a training-data pipeline; nothing outside this folder and the entry module imports them."""
