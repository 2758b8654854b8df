"""Operators of a training-data pipeline over documents, pages and vectors.

Nothing outside this package imports it; `corpus_pipeline.py` and `queries` join its operators to the driver.
"""
