"""Warehouse tables as they are stored."""

from feedhouse.fixed import STAGING_COLUMNS
from feedhouse.operators.dimension import DIM_SCHEMA

# hash_prefix comes from the folder name, so a look for hashes reads the folders of their first digits only.
STAGING = (
    "stg_id bigint, source_file string, source_row bigint, source_hash string, pipeline_run_id string, "
    "ingested_at timestamp, pipeline_version string, "
    + ", ".join(f"{c} string" for c in STAGING_COLUMNS.values())
    + ", is_valid boolean, quality_issues string, hash_prefix string"
)
COUNTRY = (
    "country_key bigint, country_code string, country_name string, region string, is_valid boolean, "
    "created_at timestamp"
)
IMPORT_DATE = (
    "date_key int, full_date date, year int, quarter int, month int, month_name string, week_of_year int, "
    "day_of_week int, day_name string, is_weekend boolean, fiscal_quarter int"
)
# import_month comes from the folder name, so a month can be read without touching the others.
FACT = (
    "import_key bigint, customer_key bigint, country_key bigint, date_key int, pipeline_run_id string, "
    "source_file string, source_row bigint, was_valid boolean, api_sent boolean, api_success boolean, "
    "api_attempts int, imported_at timestamp, import_month string"
)
LANDED_FILES = "landed_file string"

TABLES = {
    "stg_customers": STAGING,
    "dim_country": COUNTRY,
    "dim_import_date": IMPORT_DATE,
    "dim_customer": DIM_SCHEMA,
    "fact_customer_imports": FACT,
    "landed_files": LANDED_FILES,
}
