"""Registered queries, by area. Importing the modules registers them."""

from vintora.queries import asof, capture, control, diff, periods, rules, text  # noqa: F401
from vintora.plans.registry import ORACLES, QUERIES  # noqa: F401
