"""Ratings, review counts and online status from listing pages of two platforms.

A page tells by its address whose it is: the platform's pattern finds the listing id in the url, and
pages of other addresses are not looked at. Of several pages of a listing the newest counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.joins import keep_first


@dataclass(frozen=True)
class Platform:
    """How one platform's page is found and read."""

    listing: str
    rating: str
    reviews: str
    closed: Sequence[str]


PLATFORM_A = Platform(X.LISTING_PATTERN_A, X.RATING_PATTERN_A, X.REVIEWS_PATTERN_A, X.CLOSED_PHRASES_A)
PLATFORM_B = Platform(X.LISTING_PATTERN_B, X.RATING_PATTERN_B, X.REVIEWS_PATTERN_B, X.CLOSED_PHRASES_B)


def read_pages(pages: DataFrame, platform: Platform, suffix: str, newest: str = "fetched_at") -> DataFrame:
    """Listing id, rating, reviews, status: one row per listing of the platform, from its newest page.

    The page text goes no further than the projection; ties in ``newest`` go by what the page says.
    """
    names = [f"{c}_{suffix}" for c in ("listing", "rating", "reviews", "status")]
    own = pages.withColumn("_id", X.captured("url", platform.listing)).filter(F.col("_id").isNotNull())
    read = own.select(
        F.col("_id").alias(names[0]),
        X.page_number("html", platform.rating).alias(names[1]),
        X.captured("html", platform.reviews).alias(names[2]),
        X.page_status("html", platform.closed).alias(names[3]),
        F.col(newest).alias("_newest"),
    )
    order = [F.desc_nulls_last("_newest"), *[F.asc_nulls_last(c) for c in names[1:]]]
    return keep_first(read, names[:1], order).drop("_newest")


def listing_ratings(
    listings: DataFrame, pages: DataFrame, a: Platform = PLATFORM_A, b: Platform = PLATFORM_B, newest: str = "fetched_at"
) -> DataFrame:
    """One row per listing, always; a page that was not fetched leaves its columns missing."""
    side_a, side_b = read_pages(pages, a, "a", newest), read_pages(pages, b, "b", newest)
    return (
        listings.join(side_a, "listing_a", "left")
        .join(side_b, "listing_b", "left")
        .select(
            "brand", "store_name", "region", "rating_a", "rating_b", "reviews_a", "reviews_b", "status_a", "status_b"
        )
    )
