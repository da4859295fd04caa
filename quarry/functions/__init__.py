"""Scalar Column builders shared by the operators (all native expressions)."""

from quarry.functions.expressions import *  # noqa: F401,F403
