"""Kept under its former name."""

from rowmill.operators.joins import SALT, spread_lookup  # noqa: F401
