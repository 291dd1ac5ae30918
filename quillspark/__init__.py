"""quillspark: literature-corpus analytics as PySpark DataFrame operators."""

from quillspark.audit import OpResult

__all__ = ["OpResult"]
