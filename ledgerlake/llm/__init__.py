"""Operators for large-scale training-data pipelines.

One module per operator; ``registry.py`` holds the registered queries.
Nothing outside this subpackage imports it (``__spark_entry__`` adds its
queries only when it can be imported).
"""
