"""Registered queries, grouped by family."""
from . import (cleaning, evaluation, features, joining, modeling, profiles, sources, splits,  # noqa: F401
               temporal)
from .registry import ORACLES, QUERIES  # noqa: F401
