"""Layered trip analytics on Spark: landing -> raw -> silver -> gold."""

from tidemark.model import Layout, RunKey
from tidemark.plans.gold import build_gold
from tidemark.plans.monthly import finish_months, load_month, run_month
from tidemark.plans.raw import load_raw
from tidemark.plans.silver import load_silver

__all__ = [
    "Layout",
    "RunKey",
    "build_gold",
    "finish_months",
    "load_month",
    "load_raw",
    "load_silver",
    "run_month",
]
