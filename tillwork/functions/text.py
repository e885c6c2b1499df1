"""Keys, recodes, channel groups, offer codes, page extraction and display text."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import as_col, round_he

# ---- fixed values -------------------------------------------------------
# Channel groups: the first rule with a needle in the upper-cased channel wins.
CHANNEL_RULES = (
    ("Swiggy", ("SWIGGY",)),
    ("Zomato", ("ZOMATO",)),
    ("In Store", ("POS", "DINE")),
    ("Ownly", ("OWNLY", "WEBSITE")),
)
CHANNEL_DEFAULT = "Others"

REGION_CODES = {"KERALA": "KL", "KARNATAKA": "KA", "MAHARASHTRA": "MH", "TAMIL NADU": "TN"}

NO_OFFER = "No Offer"
VOUCHER_PATTERN = r"Merchant Voucher Code\s*\((.*?)\)"
LISTED_NAME_PATTERN = r"'name':\s*'(.*?)'"
RESTAURANT_PATTERN = r"Restaurant Discount\s*\((.*?)\)"
BRACKET_PATTERN = r"\((.*?)\)"

LISTING_PATTERN_A = r"swiggy\.com/restaurants/([^/?#]+)"
LISTING_PATTERN_B = r"zomato\.com/r/([^/?#]+)"
RATING_PATTERN_A = r'"avgRating":"?([\d.]+)"?'
REVIEWS_PATTERN_A = r'"totalRatingsString":"([^"]+)"'
CLOSED_PHRASES_A = ("restaurant unavailable",)
RATING_PATTERN_B = r'"ratingV2":"([\d.]+)"'
REVIEWS_PATTERN_B = r'"reviewCount":"(\d+)"'
CLOSED_PHRASES_B = (
    "currently not accepting orders",
    "temporarily closed",
    "online ordering not available",
)

MISSING_MARKS = ("", "#N/A", "nan", "None")
# -------------------------------------------------------------------------


def null_if_missing(x: Column | str, marks: Sequence[str] = MISSING_MARKS) -> Column:
    """Trim; sheet sentinels become NULL."""
    trimmed = F.trim(as_col(x))
    return F.when(~trimmed.isin(*marks), trimmed)


def key_of(x: Column | str) -> Column:
    """Canonical join key: trimmed, upper case."""
    return F.upper(F.trim(as_col(x)))


def same_text(x: Column | str, literal: str) -> Column:
    return key_of(x) == F.lit(literal.strip().upper())


def has_text(x: Column | str, needle: str, ignore_case: bool = True) -> Column:
    """Contains; missing text contains nothing."""
    x = F.coalesce(as_col(x), F.lit(""))
    return F.upper(x).contains(needle.upper()) if ignore_case else x.contains(needle)


def recode(x: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace known names by their code; other names pass, trimmed and upper-cased."""
    key = key_of(x)
    table = F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])
    return F.coalesce(F.try_element_at(table, key), key)


def region_code(x: Column | str, mapping: Mapping[str, str] | None = None) -> Column:
    return recode(x, mapping or REGION_CODES)


def channel_group(
    x: Column | str,
    rules: Sequence[tuple[str, Sequence[str]]] = CHANNEL_RULES,
    default: str = CHANNEL_DEFAULT,
) -> Column:
    """Ordered, case-insensitive contains; anything else (missing too) is ``default``."""
    upper = F.upper(F.coalesce(as_col(x), F.lit("")))
    chain = None
    for label, needles in rules:
        hit = upper.contains(needles[0])
        for needle in needles[1:]:
            hit = hit | upper.contains(needle)
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain.otherwise(default)


def first_match(x: Column | str, pattern: str, group: int = 1) -> Column:
    """The captured text, or NULL when the pattern does not occur."""
    x = as_col(x)
    return F.when(x.rlike(pattern), F.regexp_extract(x, pattern, group))


def captured(x: Column | str, pattern: str, group: int = 1) -> Column:
    """As ``first_match`` for a pattern that captures at least one character; the text is searched once."""
    return F.nullif(F.regexp_extract(as_col(x), pattern, group), F.lit(""))


def offer_code(text: Column | str, patterns: Sequence[str], default: str = NO_OFFER) -> Column:
    """First pattern that occurs in free discount text."""
    return F.coalesce(*[first_match(text, p) for p in patterns], F.lit(default))


def voucher_offer(text: Column | str) -> Column:
    return offer_code(text, (VOUCHER_PATTERN, LISTED_NAME_PATTERN))


def restaurant_offer(text: Column | str) -> Column:
    return offer_code(text, (RESTAURANT_PATTERN,))


def listed_offer(discounts: Column | str, pattern: str, default: str = NO_OFFER) -> Column:
    """Code of the first structured discount: captured text, else its name, else ``default``."""
    name = F.get(as_col(discounts), F.lit(0))["name"]
    return F.coalesce(first_match(name, pattern), name, F.lit(default))


def bracket_code(discounts: Column | str) -> Column:
    return listed_offer(discounts, BRACKET_PATTERN)


def voucher_code(discounts: Column | str) -> Column:
    return listed_offer(discounts, VOUCHER_PATTERN)


def embedded_json(html: Column | str, kind: str = "application/ld+json") -> Column:
    """The JSON text of a page's first script block of a type, missing if there is none or it is no JSON.

    The block ends at the first closing tag, as in HTML: JSON inside writes it with an escaped slash.
    """
    block = captured(html, rf"(?is)<script[^>]*\btype=[\"']?{re.escape(kind)}[\"']?[^>]*>\s*(.*?)\s*</script")
    return F.when(F.try_parse_json(block).isNotNull(), block)


def embedded_value(block: Column | str, path: str, html: Column | str, pattern: str) -> Column:
    """A field of the embedded JSON by its path, wherever it stands; the pattern over the page where the block has none."""
    return F.coalesce(F.get_json_object(as_col(block), path), captured(html, pattern))


def page_number(html: Column | str, pattern: str) -> Column:
    return captured(html, pattern).try_cast("double")


def page_status(html: Column | str, closed_phrases: Sequence[str]) -> Column:
    """Offline when any closing phrase occurs in the lower-cased page."""
    lower = F.lower(as_col(html))
    hit = lower.contains(closed_phrases[0].lower())
    for phrase in closed_phrases[1:]:
        hit = hit | lower.contains(phrase.lower())
    return F.when(hit, "Offline").otherwise("Online")


def composite_key(*parts: Column | str) -> Column:
    """Parts joined by a bar; a missing part keeps its place as empty text."""
    return F.concat_ws("|", *[F.coalesce(as_col(p).cast("string"), F.lit("")) for p in parts])


def split_list(x: Column | str, sep: str = ",") -> Column:
    """Comma list -> distinct trimmed entries without blanks; missing -> empty array."""
    parts = F.transform(F.split(F.coalesce(as_col(x), F.lit("")), sep), lambda p: F.trim(p))
    return F.array_distinct(F.filter(parts, lambda p: p != ""))


def percent_text(x: Column | str) -> Column:
    """Shortest percent text of a value rounded to 2 places: 12.0%, 12.5%, 12.34%."""
    fixed = round_he(x, 2).cast("decimal(38,2)").cast("string")
    return F.concat(F.regexp_replace(fixed, "0$", ""), F.lit("%"))


def dash_if_zero(x: Column | str) -> Column:
    x = as_col(x)
    return F.when(x.isNull() | (x == 0), "-").otherwise(x.cast("string"))


def scope_label(region: Column | str) -> Column:
    return F.concat(F.lit("Region: "), as_col(region))
