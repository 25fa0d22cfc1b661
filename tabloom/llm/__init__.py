"""Operators for preparing training data, each in a module of its own.

Nothing else in the package imports this one. ``tabloom.llm.queries`` registers a query per
operator; the modules hold the operators themselves, with their general interface.
"""
