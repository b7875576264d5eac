"""Operators of a training-data pipeline, one module each.

Nothing outside this package imports it. ``queries`` holds the registered
``opN_*`` queries; ``corpus_pipeline.py`` at the repository top chains five of
the operators.
"""
