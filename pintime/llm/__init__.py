"""Operators for training-data pipelines over ``documents``, ``pages`` and ``conversations``.

One module per operator; ``queries`` registers them. Nothing outside this
package imports it (``__spark_entry__`` adds it only if it can be imported).
"""
