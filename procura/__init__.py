"""procura: purchase-order outstanding-value extracts as Spark DataFrame operators."""

from .config import ExtractConfig

__all__ = ["ExtractConfig"]
