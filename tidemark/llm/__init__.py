"""Operators for preparing training text at corpus scale.

Nothing else in the library imports this subpackage. Each operator is a module of
its own; ``queries`` registers one query per operator.
"""
