"""Operators for preparing language-model training data.

One module per operator, each with its own registered query; nothing outside
this subpackage imports it (the entry module adds its queries when present).
"""
