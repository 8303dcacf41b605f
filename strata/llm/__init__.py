"""Operators of a training-data pipeline, one module per operator.

Nothing outside this folder imports it. ``queries`` holds the registered
queries; ``common`` what several operators share.
"""
