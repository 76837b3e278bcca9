"""Operators for training-data pipelines over documents, pages and conversations.

Nothing else in the package imports this subpackage; ``queries`` registers one
``opN_<name>`` query per operator.
"""
