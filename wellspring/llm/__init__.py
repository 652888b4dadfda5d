"""Operators for large-scale training-data pipelines.

Nothing outside this package imports it. Work is partitioned and shuffled by Spark; numpy and
Arrow are used inside tasks where an operator is not expressible with built-in functions.
"""
