"""ladle: retail and dining analytics as lazy PySpark DataFrame operators."""

from ladle.config import Config

__all__ = ["Config"]
