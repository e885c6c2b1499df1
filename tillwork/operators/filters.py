"""Row predicates the reports share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import null_if_missing, same_text

# Company-owned stores, and the wider rule of the stock ledger.
COMPANY_OWNED = "COCO"
LEDGER_OWNERSHIP = r"COCO|WARE|WH"


def company_owned(ownership: Column | str) -> Column:
    return same_text(ownership, COMPANY_OWNED)


def ledger_store(ownership: Column, code: Column, explicit: Sequence[str] = ()) -> Column:
    """Ownership matches the ledger rule, or the code is listed."""
    rule = F.coalesce(F.upper(F.trim(ownership)).rlike(LEDGER_OWNERSHIP), F.lit(False))
    return rule | F.coalesce(F.trim(code).isin(*explicit), F.lit(False)) if explicit else rule


def usable_code(code: Column | str) -> Column:
    """Not missing, blank or #N/A."""
    return null_if_missing(code).isNotNull()


def valid_metric(x: Column | str) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return x.isNotNull() & (x >= 0)


def not_addon(mix: Column | str, addon: str = "ADDONS") -> Column:
    """Add-ons are dropped, missing mixes kept."""
    mix = F.col(mix) if isinstance(mix, str) else mix
    return ~F.upper(mix).eqNullSafe(addon)


def p80_breach(kpt: Column, o2d: Column, orders: Column, min_orders: Column | int = 0) -> Column:
    """P80 preparation over 12 or P80 delivery over 35 minutes."""
    return ((kpt > 12.0) | (o2d > 35.0)) & (orders >= min_orders)
