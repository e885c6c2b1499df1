"""The reports run on the driver's tables, each with its SQL twin."""

from __future__ import annotations

from . import incremental, landing, product, scalars, shaping, sla, soldout, stock
from .registry import ORACLES, QUERIES

FAMILIES = (product, sla, stock, soldout, landing, shaping, scalars, incremental)


def queries():
    return dict(QUERIES)


def oracles():
    return dict(ORACLES)
