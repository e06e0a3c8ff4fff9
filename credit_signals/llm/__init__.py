"""Operators for training-data pipelines over text tables.

Nothing else in the library imports this package.  Each module holds one
operator with a general interface; ``queries`` wraps them for the driver.
"""
