"""Column-level helpers: casts, Paris wall clock, money, rules, time windows."""

from linefold.functions import columns, constants, timewin

__all__ = ["columns", "constants", "timewin"]
