"""All registered queries."""

from __future__ import annotations

from wardline.plans import diagnosis, engineering, evaluation, modelling, preparation, rebalancing  # noqa: F401
from wardline.plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
