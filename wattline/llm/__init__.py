"""Operators of a training-data pipeline over text tables.

Nothing outside this folder imports it; ``queries`` registers one query per operator.
"""
