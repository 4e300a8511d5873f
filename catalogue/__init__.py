"""Registered queries and the independent SQL they are compared with."""

from catalogue import alerting, governance, platform, profiles, quality, streams  # noqa: F401
from catalogue.registry import ORACLE, QUERIES  # noqa: F401
