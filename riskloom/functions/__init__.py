"""Scalar column helpers (built-in expressions only, so they stay inside codegen)."""

from riskloom.functions.scalar import *  # noqa: F401,F403
