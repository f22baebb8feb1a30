"""Rule configuration as frozen dataclasses plus the fixed lookup values.

Values under "FIXED VALUES" must equal the business rules the operators
reproduce (labels, prefixes, patterns, priorities); they are data, kept in
their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping

# ---------------------------------------------------------------------------
# FIXED VALUES — claims → transactions rules
# ---------------------------------------------------------------------------
TRANSACTION_TYPE_MAPPING: dict[str, str] = {
    "1": "Private",
    "2": "Corporate",
    "3": "SME",
    "4": "Government",
    "5": "NonProfit",
    "6": "GroupPolicy",
    "7": "BrokerSubmitted",
    "8": "PartnerNetwork",
    "9": "Reinsurance",
    "10": "Internal",
}
TRANSACTION_TYPE_DEFAULT = "Unknown"
TRANSACTION_DIRECTION_MAPPING: dict[str, str] = {
    "CL": "COINSURANCE",
    "RX": "REINSURANCE",
    "RI": "INWARD_REINSURANCE",
    "DI": "DIRECT",
    "RC": "RECOVERY",
}
CATEGORY_NEGATIVE = "REFUND"
CATEGORY_POSITIVE = "CHARGE"
CLAIM_ID_PATTERN = r"^[A-Z]{2}_\d+$"
TRANSACTIONS_COLUMNS = [
    "CONTRACT_SOURCE_SYSTEM", "CONTRACT_SOURCE_SYSTEM_ID", "SOURCE_SYSTEM_ID",
    "TRANSACTION_TYPE", "TRANSACTION_DIRECTION", "CONFORMED_VALUE",
    "BUSINESS_DATE", "CREATION_DATE", "SYSTEM_TIMESTAMP",
    "NSE_ID", "TRANSACTION_CATEGORY",
]
CLAIMS_COLUMNS = [
    "SOURCE_SYSTEM", "CLAIM_ID", "CONTRACT_SOURCE_SYSTEM", "CONTRACT_ID",
    "CLAIM_TYPE", "DATE_OF_LOSS", "AMOUNT", "CREATION_DATE",
]
CONTRACTS_COLUMNS = [
    "SOURCE_SYSTEM", "CONTRACT_ID", "CONTRACT_TYPE",
    "INSURED_PERIOD_FROM", "INSURED_PERIOD_TO", "CREATION_DATE",
]
# region label, date pattern, timestamp pattern
REGION_FORMATS: list[tuple[str, str, str]] = [
    ("Europe 3", "dd.MM.yyyy", "dd.MM.yyyy HH:mm"),
    ("Asia Pacific 1", "yyyy-MM-dd", "yyyy-MM-dd HH:mm"),
    ("North America 2", "MM/dd/yyyy", "MM/dd/yyyy HH:mm"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — observation table
# ---------------------------------------------------------------------------
DEDUP_KEY = ["ref_area", "counterpart", "time_period", "var_code", "sex"]
SOURCE_PRIORITY: dict[str, int] = {
    "OECD_MIG": 0,
    "EUROSTAT": 1,
    "IRCC": 2,
    "FALLBACK_CSV": 3,
    "FALLBACK_XLSX": 4,
}
UNKNOWN_SOURCE_RANK = 99
CANONICAL_COLUMNS = [
    "ref_area", "ref_area_name", "counterpart", "counterpart_name",
    "time_period", "year", "quarter", "var_code", "metric",
    "sex", "gender", "area_name", "reg_name", "province",
    "imm_category", "obs_value", "obs_status", "source_dataset", "fetch_ts",
]
# Aggregate counterpart codes left out of origin totals.
AGGREGATE_COUNTERPARTS = ["_T", "_O", "_R", "UNK", "TOT", ""]
# Freshness window per source, hours.
SOURCE_TTL_HOURS: dict[str, int] = {"OECD_MIG": 24, "EUROSTAT": 12, "IRCC": 168}
# Labels of the positional migration file's codes.
VAR_TO_METRIC: dict[str, str] = {
    "B11": "Inflows of Foreign Population",
    "B12": "Outflows of Foreign Population",
    "B13": "Asylum Seekers",
    "B14": "Stock of Foreign-Born Population",
    "B15": "Stock of Foreign Nationals",
    "B16": "Citizenship Acquisition",
    "B21": "Outflows of National Population",
}
GEN_TO_GENDER: dict[str, str] = {"TOT": "Total", "MAS": "Male", "FEM": "Female",
                                 "T": "Total", "M": "Male", "F": "Female"}
MIGRATION_FILE_COLUMNS = ["CO2", "Country_Nationality", "VAR", "Variable", "GEN", "Gender",
                          "COU", "Country", "YEA", "Year", "Value"]
# Pivot-table dimensions offered to users.
PIVOT_DIMENSIONS = ["year", "counterpart_name", "metric", "gender",
                    "area_name", "reg_name", "province", "imm_category"]
PROVINCE_ISO: dict[str, str] = {
    "Ontario": "CA-ON", "Quebec": "CA-QC", "British Columbia": "CA-BC",
    "Alberta": "CA-AB", "Manitoba": "CA-MB", "Saskatchewan": "CA-SK",
    "Nova Scotia": "CA-NS", "New Brunswick": "CA-NB",
    "Newfoundland and Labrador": "CA-NL", "Prince Edward Island": "CA-PE",
    "Northwest Territories": "CA-NT", "Yukon": "CA-YT", "Nunavut": "CA-NU",
}
COUNTRY_ISO3: dict[str, str] = {
    "Afghanistan": "AFG", "Albania": "ALB", "Algeria": "DZA",
    "Argentina": "ARG", "Australia": "AUS", "Austria": "AUT",
    "Bangladesh": "BGD", "Belgium": "BEL", "Brazil": "BRA",
    "Bulgaria": "BGR", "Cambodia": "KHM", "Cameroon": "CMR",
    "Chile": "CHL", "China": "CHN", "Colombia": "COL",
    "Croatia": "HRV", "Cuba": "CUB", "Czech Republic": "CZE",
    "Denmark": "DNK", "Ecuador": "ECU", "Egypt": "EGY",
    "El Salvador": "SLV", "Ethiopia": "ETH", "Finland": "FIN",
    "France": "FRA", "Germany": "DEU", "Ghana": "GHA",
    "Greece": "GRC", "Guatemala": "GTM", "Haiti": "HTI",
    "Honduras": "HND", "Hong Kong": "HKG", "Hungary": "HUN",
    "India": "IND", "Indonesia": "IDN", "Iran": "IRN",
    "Iraq": "IRQ", "Ireland": "IRL", "Israel": "ISR",
    "Italy": "ITA", "Jamaica": "JAM", "Japan": "JPN",
    "Jordan": "JOR", "Kenya": "KEN", "Korea, Republic of": "KOR",
    "South Korea": "KOR", "Lebanon": "LBN", "Malaysia": "MYS",
    "Mexico": "MEX", "Morocco": "MAR", "Nepal": "NPL",
    "Netherlands": "NLD", "New Zealand": "NZL", "Nigeria": "NGA",
    "Norway": "NOR", "Pakistan": "PAK", "Peru": "PER",
    "Philippines": "PHL", "Poland": "POL", "Portugal": "PRT",
    "Romania": "ROU", "Russia": "RUS", "Russian Federation": "RUS",
    "Saudi Arabia": "SAU", "Somalia": "SOM", "South Africa": "ZAF",
    "Spain": "ESP", "Sri Lanka": "LKA", "Sudan": "SDN",
    "Sweden": "SWE", "Switzerland": "CHE", "Syria": "SYR",
    "Syrian Arab Republic": "SYR", "Taiwan": "TWN", "Tanzania": "TZA",
    "Thailand": "THA", "Trinidad and Tobago": "TTO", "Tunisia": "TUN",
    "Turkey": "TUR", "Türkiye": "TUR", "Uganda": "UGA",
    "Ukraine": "UKR", "United Kingdom": "GBR", "United States": "USA",
    "Venezuela": "VEN", "Viet Nam": "VNM", "Vietnam": "VNM",
    "Zimbabwe": "ZWE", "All Countries": "_T", "Total": "_T",
}


@dataclass(frozen=True)
class JoinKeys:
    claim_contract_id: str = "CONTRACT_ID"
    claim_source_system: str = "CONTRACT_SOURCE_SYSTEM"
    contract_id: str = "CONTRACT_ID"
    contract_source_system: str = "SOURCE_SYSTEM"


@dataclass(frozen=True)
class TransactionRules:
    """One region's rule set (what a per-region parameter file holds)."""
    source_system: str = "Europe 3"
    type_mapping: Mapping[str, str] = field(default_factory=lambda: dict(TRANSACTION_TYPE_MAPPING))
    type_default: str = TRANSACTION_TYPE_DEFAULT
    direction_mapping: Mapping[str, str] = field(
        default_factory=lambda: dict(TRANSACTION_DIRECTION_MAPPING))
    category_negative: str = CATEGORY_NEGATIVE
    category_positive: str = CATEGORY_POSITIVE
    date_format: str = "dd.MM.yyyy"
    timestamp_format: str = "dd.MM.yyyy HH:mm"
    join: JoinKeys = field(default_factory=JoinKeys)


def region_rules() -> list[TransactionRules]:
    return [TransactionRules(source_system=name, date_format=d, timestamp_format=t)
            for name, d, t in REGION_FORMATS]
