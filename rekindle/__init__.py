"""rekindle — customer revival analytics on PySpark (see README)."""

from .config import ADAPTER_A, ADAPTER_B, REFERENCE, RevivalConfig

__all__ = ["ADAPTER_A", "ADAPTER_B", "REFERENCE", "RevivalConfig"]
