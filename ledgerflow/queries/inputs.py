"""Banking inputs derived from the given tables.

Each block is one SQL text that Spark and DuckDB both run; ``{name}`` stands
for a table or another block.
"""

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.operators.size import shared_folder

AS_OF = "2024-01-01"
STAMP = "2024-01-01 00:00:00"
LATER = "2024-01-01 06:00:00"
NEXT_DAY = "2024-01-02 00:00:00"

BLOCKS = {
    "customers_raw": """
select cast(c_custkey as string) as customer_id,
  case when c_custkey % 17 <> 0 then 'First' || cast(c_custkey % 97 as string) end as first_name,
  'Last' || cast(c_custkey % 89 as string) as last_name,
  case when c_custkey % 41 <> 0 then DATE '1940-01-01' + cast(c_custkey * 101 % 22000 as int) end as date_of_birth,
  cast(100000000 + c_custkey as string) as ssn,
  'c' || cast(c_custkey as string) || '@example.com' as email,
  '555-' || cast(1000000 + c_custkey as string) as phone_number,
  c_name as address_line1,
  case when c_custkey % 3 <> 0 then 'Apt ' || cast(c_custkey % 50 as string) end as address_line2,
  n_name as city,
  case when c_custkey % 5 <> 0 then r_name end as state,
  cast(10000 + c_custkey % 80000 as string) as zip_code,
  'USA' as country,
  DATE '2000-01-01' + cast(c_custkey * 37 % 8000 as int) as customer_since,
  c_mktsegment as segment,
  case when c_custkey % 23 <> 0 then cast(300 + c_custkey * 37 % 551 as decimal(5,0)) end as credit_score,
  case when c_custkey % 29 <> 0 then cast(cast(round(c_acctbal * 100) as bigint) * 2 as decimal(15,2)) end as total_assets,
  case when c_custkey % 31 = 0 then null when c_custkey % 4 = 0 then 'PENDING' else 'COMPLETE' end as kyc_status,
  DATE '2023-12-01' + cast(c_custkey % 31 as int) as last_updated
from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
""",
    "accounts_raw": """
select cast(o_orderkey as string) as account_id,
  cast(o_custkey as string) as customer_id,
  case when o_orderkey % 2 = 0 then 'CHECKING' else 'SAVINGS' end as account_type,
  o_orderpriority as account_subtype,
  cast(o_orderdate as date) as open_date,
  case when o_orderstatus = 'F' then cast(o_orderdate as date) + cast(30 + o_orderkey % 300 as int) end as close_date,
  case o_orderstatus when 'O' then 'ACTIVE' when 'F' then 'CLOSED' else 'DORMANT' end as status,
  case when c_nationkey = 0 then 'USD' else 'C' || cast(c_nationkey as string) end as currency_code,
  cast(cast(round(o_totalprice * 100) as bigint) as decimal(20,4)) as current_balance,
  cast(cast(round(o_totalprice * 100) as bigint) - 20000000 + o_orderkey % 7 as decimal(20,4)) as available_balance,
  case when o_orderkey % 6 <> 0 then cast(o_orderkey % 1000 as decimal(20,4)) end as hold_balance,
  cast(o_orderkey % 9 as decimal(10,4)) as interest_rate,
  case when o_orderkey % 5 <> 0 then cast(o_orderkey % 4 * 500 as decimal(15,2)) end as overdraft_limit,
  cast(o_orderdate as date) + cast(o_orderkey % 500 as int) as last_activity_date,
  'B' || cast(o_orderkey % 40 as string) as branch_id,
  c_name as primary_holder,
  case when o_orderkey % 8 = 0 then 'Joint' || cast(o_orderkey as string) end as secondary_holders,
  'M' || cast(o_orderkey % 25 as string) as account_manager,
  cast(o_orderdate as timestamp) as last_updated
from {orders} join {customer} on o_custkey = c_custkey
""",
    "exchange_rates": """
select 'C' || cast(n_nationkey as string) as from_currency,
  case when n_nationkey % 10 = 9 then 'EUR' else 'USD' end as to_currency,
  cast(cast(n_nationkey * 7 + 3 as decimal(18,8)) / 64 as decimal(18,8)) as exchange_rate
from {nation} where n_nationkey not in (0, 5)
""",
    "all_quotes": """
select * from {exchange_rates}
union all
select 'C' || cast(n_nationkey as string) as from_currency, 'EUR' as to_currency,
  cast(cast(n_nationkey as decimal(18,8)) / 16 as decimal(18,8)) as exchange_rate
from {nation} where n_nationkey in (1, 2, 3)
""",
    "customers_dirty": """
select case when cast(customer_id as bigint) % 50 = 7 then null else customer_id end as customer_id,
  segment, kyc_status, last_updated from {customers_raw}
union all
select customer_id, 'MOVED' as segment, kyc_status, last_updated + 1 as last_updated
from {customers_raw} where cast(customer_id as bigint) % 10 = 0
union all
select customer_id, segment, kyc_status, last_updated
from {customers_raw} where cast(customer_id as bigint) % 20 in (3, 7)
union all
select customer_id, 'A TIE' as segment, kyc_status, last_updated
from {customers_raw} where cast(customer_id as bigint) % 20 = 3
""",
    # A source with null ids, rows that moved, equal copies and ties.
    "customers_bad": """
select * from {customers_raw} where cast(customer_id as bigint) % 50 <> 7
union all
select * from {customers_second} where cast(customer_id as bigint) % 10 = 0
union all
select * from {customers_raw} where cast(customer_id as bigint) % 20 = 3
union all
select * from {customers_tied} where cast(customer_id as bigint) % 20 = 3
union all
select * from {customers_nameless} where cast(ssn as bigint) % 50 = 7
""",
    # The same source some hours later: every tenth customer has moved.
    "customers_second": """
select customer_id, first_name, last_name, date_of_birth, ssn, email, phone_number, address_line1,
  address_line2, city, state, zip_code, country, customer_since,
  case when cast(customer_id as bigint) % 10 = 0 then 'MOVED' else segment end as segment,
  credit_score, total_assets, kyc_status,
  case when cast(customer_id as bigint) % 10 = 0 then DATE '2024-01-01' else last_updated end as last_updated
from {customers_raw}
""",
    "customers_tied": """
select customer_id, first_name, last_name, date_of_birth, ssn, email, phone_number, address_line1,
  address_line2, city, state, zip_code, country, customer_since, 'A TIE' as segment,
  credit_score, total_assets, kyc_status, last_updated
from {customers_raw}
""",
    "customers_nameless": """
select cast(null as string) as customer_id, first_name, last_name, date_of_birth, ssn, email, phone_number,
  address_line1, address_line2, city, state, zip_code, country, customer_since, segment,
  credit_score, total_assets, kyc_status, last_updated
from {customers_raw}
""",
}

# What each block reads, in the order in which a WITH clause can state them.
READS = {
    "customers_raw": ("customer", "nation", "region"),
    "accounts_raw": ("orders", "customer"),
    "exchange_rates": ("nation",),
    "all_quotes": ("exchange_rates", "nation"),
    "customers_dirty": ("customers_raw",),
    "customers_second": ("customers_raw",),
    "customers_tied": ("customers_raw",),
    "customers_nameless": ("customers_raw",),
    "customers_bad": ("customers_raw", "customers_second", "customers_tied", "customers_nameless"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One block as a lazy DataFrame over the given tables."""
    if name not in BLOCKS:
        return table(spark, sf_dir, name)
    inputs = {read: derived(spark, sf_dir, read) for read in READS[name]}
    return spark.sql(BLOCKS[name], **inputs)


def oracle(select: str) -> str:
    """``select`` with the blocks as common table expressions before it."""
    names = {read: read for reads in READS.values() for read in reads}
    blocks = [f"{name} AS ({BLOCKS[name].format(**names)})" for name in READS]
    return f"WITH {', '.join(blocks)}\n{select}"


def scratch(spark: SparkSession, name: str) -> str:
    """The folder of one query on the storage all executors share, emptied.

    Writing an empty table over it removes what an earlier run left there.
    """
    path = f"{shared_folder(spark)}/query-{name}"
    spark.range(0).write.mode("overwrite").parquet(path)
    return path
