"""Operators for building language-model training data, each a Spark job.

Nothing outside this subpackage imports it, so it can be removed as a whole.
"""
