"""Imports every query module so the registry is complete."""

from . import q_eval, q_models, q_stats, q_stream  # noqa: F401
from .registry import QUERIES  # noqa: F401
