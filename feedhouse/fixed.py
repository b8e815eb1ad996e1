"""These must equal the published rules for results to agree."""

# Fields a customer feed is expected to carry.
EXPECTED_FIELDS = [
    "company_name", "contact_email", "contact_first_name",
    "contact_last_name", "phone_number", "tax_id",
    "company_size", "address", "city", "country", "postal_code",
]

# Fields whose absence makes a row dirty.
DQ_REQUIRED_FIELDS = ["company_name", "contact_email"]

# Fields that make up the content hash of a row.
HASH_FIELDS = ["company_name", "contact_email", "tax_id"]

# Country codes accepted by the quality check.
COUNTRY_CODES = [
    "US", "GB", "CA", "AU", "DE", "FR", "IN", "SG", "AE", "NL", "JP", "CN",
    "BR", "MX", "ZA", "NG", "KE", "PK", "BD", "PH", "ID", "TH", "VN", "MY",
    "IT", "ES", "PT", "SE", "NO", "DK", "FI", "CH", "AT", "BE", "IE", "NZ",
    "AR", "CL", "CO", "PE", "EG", "SA", "QA", "KW", "BH", "OM", "JO", "LB",
    "IL", "TR", "PL", "CZ", "HU", "RO", "BG", "HR", "SK", "SI", "EE", "LV", "LT",
]

# Countries seeded into dim_country: code, name, region.
COUNTRY_SEED = [
    ("US", "United States", "North America"),
    ("GB", "United Kingdom", "Europe"),
    ("CA", "Canada", "North America"),
    ("AU", "Australia", "Oceania"),
    ("DE", "Germany", "Europe"),
    ("FR", "France", "Europe"),
    ("IN", "India", "Asia"),
    ("SG", "Singapore", "Asia"),
    ("AE", "United Arab Emirates", "Middle East"),
    ("NL", "Netherlands", "Europe"),
]

# First and last day of the import-date dimension.
DATE_SPINE = ("2023-01-01", "2027-12-31")

# Named fact ranges [from, to); everything else is 'default'.
FACT_RANGES = [
    ("2024_01", "2024-01-01", "2024-02-01"),
    ("2024_02", "2024-02-01", "2024-03-01"),
    ("2025_01", "2025-01-01", "2025-02-01"),
    ("2025_q2", "2025-04-01", "2025-07-01"),
]

# Null-rate limits in percent: above the first a field is reported, above the second it is severe.
NULL_RATE_WARN = 50
NULL_RATE_HIGH = 80

# Delivery limits: attempts per customer, first backoff, customers per batch.
DELIVERY_ATTEMPTS = 3
BACKOFF_MS = 500
BATCH_SIZE = 5

# Longest text each column accepts.
STAGING_LENGTHS = {
    "source_file": 500, "source_hash": 64, "pipeline_run_id": 36, "pipeline_version": 20,
    "company_name": 500, "contact_email": 500, "contact_first": 200, "contact_last": 200,
    "phone_number": 100, "tax_id": 100, "company_size": 100, "city": 200, "country": 200,
    "postal_code": 50,
}
CUSTOMER_LENGTHS = {
    "company_name": 500, "contact_email": 500, "contact_first": 200, "contact_last": 200,
    "phone_number": 100, "tax_id": 100, "company_size": 100, "city": 200, "country_code": 2,
    "postal_code": 50, "source_run_id": 36,
}

# Feed column -> staging column.
STAGING_COLUMNS = {
    "company_name": "company_name", "contact_email": "contact_email",
    "contact_first_name": "contact_first", "contact_last_name": "contact_last",
    "phone_number": "phone_number", "tax_id": "tax_id", "company_size": "company_size",
    "address": "address", "city": "city", "country": "country", "postal_code": "postal_code",
}

# Default validation rules.
DEFAULT_RULES = {
    "required": ["company_name", "contact_email"],
    "email": ["contact_email"],
    "nonEmpty": ["contact_first_name", "contact_last_name"],
}

# The texts that define the four built-in transforms in shipped configurations.
SHIPPED_TRANSFORMS = {
    "trim": "value => value?.trim() ?? ''",
    "lowercase": "value => value?.trim().toLowerCase() ?? ''",
    "uppercase": "value => value?.trim().toUpperCase() ?? ''",
    "cleanPhone": "value => value?.replace(/[^\\d+\\-()\\s]/g, '').trim() ?? ''",
}

# Default mapping of feed columns to customer objects.
DEFAULT_MAPPING = {
    "fieldMappings": {
        "name": {"from": "company_name", "transform": "trim"},
        "email": {"from": "contact_email", "transform": "lowercase"},
        "taxId": {"from": "tax_id", "transform": "trim"},
        "companySize": {"from": "company_size", "transform": "trim"},
    },
    "nestedMappings": {
        "contact": {
            "firstName": {"from": "contact_first_name", "transform": "trim"},
            "lastName": {"from": "contact_last_name", "transform": "trim"},
            "phone": {"from": "phone_number", "transform": "cleanPhone"},
        },
        "address": {
            "street": {"from": "address", "transform": "trim"},
            "city": {"from": "city", "transform": "trim"},
            "country": {"from": "country", "transform": "uppercase"},
            "postalCode": {"from": "postal_code", "transform": "trim"},
        },
        "metadata": {
            "source": {"value": "csv_import"},
            "importedAt": {"value": "__NOW__"},
        },
    },
    "transforms": {name: name for name in ("trim", "lowercase", "uppercase", "cleanPhone")},
}
