"""Composed plans: the shared pipeline and the two flagship extracts."""

from .extracts import accounting_extract, tax_extract, write_extract
from .pipeline import Pipeline

__all__ = ["Pipeline", "accounting_extract", "tax_extract", "write_extract"]
