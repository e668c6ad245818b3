from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from ledgerflow.plans.customer import transform_customer_data, with_vip
from ledgerflow.schemas import CUSTOMER, CUSTOMER_OUTPUT

AS_OF = date(2024, 1, 1)

# One customer as the loads are given them.
BASE = dict(
    customer_id="CUST1001", first_name="John", last_name="Doe", date_of_birth=date(1980, 5, 15),
    ssn="123-45-6789", email="john.doe@example.com", phone_number="555-123-4567",
    address_line1="123 Main St", address_line2="Apt 4B", city="New York", state="NY",
    zip_code="10001", country="USA", customer_since=date(2015, 3, 10), segment="PREMIUM",
    credit_score=Decimal(750), total_assets=Decimal("1500000.00"), kyc_status="COMPLETE",
    last_updated=date(2023, 12, 31),
)


def profiles(spark, *changes):
    """One profile per change of the base row, in the order given."""
    rows = [tuple({**BASE, "customer_id": f"{i:04}", **c}.values()) for i, c in enumerate(changes)]
    frame = spark.createDataFrame(rows, CUSTOMER)
    return with_vip(transform_customer_data(frame, AS_OF, "2024-01-01 00:00:00")).orderBy("customer_id").collect()


def test_one_known_customer(spark):
    row, = profiles(spark, {})
    assert row.full_name == "John Doe"
    assert row.is_high_value is True
    assert row.credit_rating == "Very Good"
    assert row.is_kyc_complete is True
    assert row.is_vip is True
    assert row.current_age == 43
    assert row.customer_tenure_years == 8
    assert row.address == "123 Main St, Apt 4B, New York, NY, 10001, USA"
    assert row.record_source == "ORACLE_CUSTOMERS"
    assert row.ingestion_timestamp == datetime(2024, 1, 1)


def test_output_columns_and_types(spark):
    result = transform_customer_data(spark.createDataFrame([], CUSTOMER))
    assert result.columns == CUSTOMER_OUTPUT
    types = dict(result.dtypes)
    assert types["current_age"] == types["customer_tenure_years"] == "bigint"
    assert types["is_high_value"] == types["is_kyc_complete"] == "boolean"
    assert not {"ssn", "first_name", "address_line1"} & set(result.columns)
    assert result.count() == 0


@pytest.mark.parametrize("column", ["first_name", "last_name"])
def test_name_is_null_with_a_null_part(spark, column):
    assert profiles(spark, {column: None})[0].full_name is None


def test_address_skips_null_parts(spark):
    parts = ("address_line1", "address_line2", "city", "state", "zip_code", "country")
    some, none = profiles(
        spark, {"address_line2": None, "state": None}, dict.fromkeys(parts)
    )
    assert some.address == "123 Main St, New York, 10001, USA"
    assert none.address == ""


def test_credit_rating_bands(spark):
    scores = [800, 799, 740, 739, 670, 669, 580, 579, None]
    rows = profiles(spark, *({"credit_score": s if s is None else Decimal(s)} for s in scores))
    assert [r.credit_rating for r in rows] == [
        "Excellent", "Very Good", "Very Good", "Good", "Good", "Fair", "Fair", "Poor", "Poor",
    ]


def test_asset_thresholds(spark):
    assets = ["1000000.00", "999999.99", "500000.00", "499999.99", None]
    rows = profiles(spark, *({"total_assets": a and Decimal(a)} for a in assets))
    assert [r.is_high_value for r in rows] == [True, False, False, False, False]
    assert [r.is_vip for r in rows] == [True, True, True, False, False]


def test_vip_needs_a_good_rating(spark):
    rows = profiles(spark, *({"credit_score": Decimal(s)} for s in (800, 740, 739)))
    assert [r.is_vip for r in rows] == [True, True, False]


def test_kyc_is_case_sensitive_and_keeps_null(spark):
    rows = profiles(spark, *({"kyc_status": s} for s in ("COMPLETE", "complete", None)))
    assert [r.is_kyc_complete for r in rows] == [True, False, None]


def test_years_of_365_and_a_quarter_days(spark):
    days = [365, 366, 1461, 1460, 0]
    rows = profiles(spark, *({"date_of_birth": AS_OF - timedelta(d)} for d in days), {"date_of_birth": None})
    assert [r.current_age for r in rows] == [0, 1, 4, 3, 0, None]


def test_row_checks(spark):
    older = {"customer_id": "1", "last_updated": date(2023, 1, 1), "segment": "OLD"}
    newer = {"customer_id": "1", "last_updated": date(2023, 6, 1), "segment": "NEW"}
    rows = profiles(spark, older, newer, {"customer_id": None})
    assert [r.segment for r in rows] == ["NEW"]


def test_other_columns_are_refused(spark):
    with pytest.raises(ValueError):
        transform_customer_data(spark.createDataFrame([(1, "test")], "id bigint, name string"))


def test_current_date_is_the_default(spark):
    frame = spark.createDataFrame([tuple(BASE.values())], CUSTOMER)
    row = transform_customer_data(frame).first()
    assert row.current_age >= 43 and row.ingestion_timestamp is not None


def test_random_customers_match_plain_python(spark):
    from random import Random

    random = Random(11)

    def maybe(value):
        return None if random.random() < 0.2 else value

    changes = [
        {
            "first_name": maybe("F"), "last_name": maybe("L"), "address_line2": maybe("A"), "city": maybe("C"),
            "date_of_birth": maybe(AS_OF - timedelta(random.randrange(40000))),
            "credit_score": maybe(Decimal(random.choice([579, 580, 669, 670, 739, 740, 799, 800]))),
            "total_assets": maybe(Decimal(random.choice([499999, 500000, 999999, 1000000]))),
            "kyc_status": maybe(random.choice(["COMPLETE", "PENDING"])),
        }
        for _ in range(500)
    ]
    for row, change in zip(profiles(spark, *changes), changes, strict=True):
        score, assets, born = change["credit_score"], change["total_assets"], change["date_of_birth"]
        names = change["first_name"], change["last_name"]
        rating = next(
            (name for name, low in [("Excellent", 800), ("Very Good", 740), ("Good", 670), ("Fair", 580)]
             if score is not None and score >= low), "Poor",
        )
        parts = ["123 Main St", change["address_line2"], change["city"], "NY", "10001", "USA"]
        assert row.full_name == (None if None in names else "F L")
        assert row.address == ", ".join(p for p in parts if p)
        assert row.current_age == (None if born is None else int((AS_OF - born).days / 365.25))
        assert row.credit_rating == rating
        assert row.is_high_value == (assets is not None and assets >= 1000000)
        assert row.is_vip == (assets is not None and assets >= 500000 and rating in ("Excellent", "Very Good"))
        assert row.is_kyc_complete == (change["kyc_status"] and change["kyc_status"] == "COMPLETE")
