"""Column-level helpers: each returns a ``Column`` built from built-in Spark functions."""

from .clock import wall_clock

__all__ = ["wall_clock"]
