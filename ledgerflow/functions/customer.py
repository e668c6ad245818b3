"""Customer rules: one column expression each, all inside whole-stage codegen."""

from pyspark.sql import Column, functions as F

# Lowest score of each rating, best first.
CREDIT_BANDS = {"Excellent": 800, "Very Good": 740, "Good": 670, "Fair": 580}
LOWEST_RATING = "Poor"

# Asset thresholds, VIP ratings and the finished KYC status.
HIGH_VALUE_ASSETS = 1_000_000
VIP_ASSETS = 500_000
VIP_RATINGS = ("Excellent", "Very Good")
KYC_DONE = "COMPLETE"

# Parts of an address in order.
ADDRESS_PARTS = ("address_line1", "address_line2", "city", "state", "zip_code", "country")


def full_name() -> Column:
    """Null when either part is null."""
    return F.concat("first_name", F.lit(" "), "last_name")


def address() -> Column:
    """Null parts are left out; no part at all gives an empty text."""
    return F.concat_ws(", ", *ADDRESS_PARTS)


def is_high_value() -> Column:
    """Unknown assets count as not high value."""
    return F.coalesce(F.col("total_assets") >= HIGH_VALUE_ASSETS, F.lit(False))


def credit_rating() -> Column:
    """Best band whose lowest score is reached; unknown scores rate lowest."""
    reached = [
        F.when(F.col("credit_score") >= score, F.lit(rating))
        for rating, score in CREDIT_BANDS.items()
    ]
    return F.coalesce(*reached, F.lit(LOWEST_RATING))


def is_kyc_complete() -> Column:
    """Case-sensitive; an unknown status stays null."""
    return F.col("kyc_status") == KYC_DONE


def is_vip() -> Column:
    """Reads the derived ``credit_rating``; unknown assets are no VIP."""
    wealthy = F.col("total_assets") >= VIP_ASSETS
    return F.coalesce(wealthy & F.col("credit_rating").isin(*VIP_RATINGS), F.lit(False))
