"""Operators of a training-data pipeline. Nothing else in the package imports
this subpackage; ``QUERIES`` and ``SQL`` in :mod:`tickloom.llm.queries` are what
the driver entry adds when the subpackage is present."""
