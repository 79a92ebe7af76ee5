"""Layered batch pipelines over nested JSON, written as plain Spark DataFrame jobs."""

from oreflow.settings import Settings

__all__ = ["Settings"]
