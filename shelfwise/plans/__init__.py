"""Registered queries and their SQL equivalents."""

from shelfwise.plans import eda, cleaning, features, basket, series, metrics, clusters, models, reports  # noqa: F401
from shelfwise.plans.registry import QUERIES, SQL  # noqa: F401
