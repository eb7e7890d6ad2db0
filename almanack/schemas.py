"""Names, keys, measures, declared schemas and fixed lookup values."""

from __future__ import annotations

from pyspark.sql import types as T

DATASETS = ("generation", "demand", "emissions", "carbon_intensity", "capacity")
CORE_DATASETS = ("generation", "demand", "emissions", "carbon_intensity")
ENERGY_SERIES_DATASETS = ("generation", "emissions")

COMMON_COLUMNS = ("entity", "entity_code", "date")

MEASURES = {
    "generation": ("generation_twh", "share_of_generation_pct"),
    "demand": ("demand_twh",),
    "emissions": ("emissions_mtco2", "share_of_emissions_pct"),
    "carbon_intensity": ("emissions_intensity_gco2_per_kwh",),
    "capacity": ("capacity_gw", "capacity_w_per_capita"),
}

# Datasets broken down by series carry two flags; the others have none required.
FLAGS = {
    name: ("is_aggregate_entity", "is_aggregate_series")
    for name in ("generation", "emissions", "capacity")
}

BUSINESS_KEYS = {
    name: ("entity_code", "date", "series") if name in FLAGS else ("entity_code", "date")
    for name in DATASETS
}

DIMENSION_KEYS = {
    "dim_date": ("date",),
    "dim_country": ("entity_code",),
    "dim_energy_series": ("series_key",),
    "dim_capacity_series": ("capacity_series_key",),
}

FACT_GRAINS = {
    "fact_generation": ("date", "entity_code", "series_key"),
    "fact_emissions": ("date", "entity_code", "series_key"),
    "fact_demand": ("date", "entity_code"),
    "fact_carbon_intensity": ("date", "entity_code"),
    "fact_capacity": ("date", "entity_code", "capacity_series_key"),
}

FACT_MEASURES = {f"fact_{name}": columns for name, columns in MEASURES.items()}

FOREIGN_KEYS = {
    "date": "dim_date",
    "entity_code": "dim_country",
    "series_key": "dim_energy_series",
    "capacity_series_key": "dim_capacity_series",
}

GOLD_TABLES = tuple(DIMENSION_KEYS) + tuple(FACT_GRAINS)

STRING = T.StringType()
BOOLEAN = T.BooleanType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
TIMESTAMP = T.TimestampNTZType()

SILVER_SCHEMAS = {
    "generation": T.StructType(
        [
            T.StructField("entity", STRING),
            T.StructField("entity_code", STRING),
            T.StructField("is_aggregate_entity", BOOLEAN),
            T.StructField("date", TIMESTAMP),
            T.StructField("series", STRING),
            T.StructField("is_aggregate_series", BOOLEAN),
            T.StructField("generation_twh", DOUBLE),
            T.StructField("share_of_generation_pct", DOUBLE),
        ]
    ),
    "demand": T.StructType(
        [
            T.StructField("entity", STRING),
            T.StructField("entity_code", STRING),
            T.StructField("date", TIMESTAMP),
            T.StructField("demand_twh", DOUBLE),
        ]
    ),
    "emissions": T.StructType(
        [
            T.StructField("entity", STRING),
            T.StructField("entity_code", STRING),
            T.StructField("is_aggregate_entity", BOOLEAN),
            T.StructField("date", TIMESTAMP),
            T.StructField("series", STRING),
            T.StructField("is_aggregate_series", BOOLEAN),
            T.StructField("emissions_mtco2", DOUBLE),
            T.StructField("share_of_emissions_pct", DOUBLE),
        ]
    ),
    "carbon_intensity": T.StructType(
        [
            T.StructField("entity", STRING),
            T.StructField("entity_code", STRING),
            T.StructField("date", TIMESTAMP),
            T.StructField("emissions_intensity_gco2_per_kwh", DOUBLE),
        ]
    ),
    "capacity": T.StructType(
        [
            T.StructField("entity", STRING),
            T.StructField("entity_code", STRING),
            T.StructField("is_aggregate_entity", BOOLEAN),
            T.StructField("date", TIMESTAMP),
            T.StructField("series", STRING),
            T.StructField("is_aggregate_series", BOOLEAN),
            T.StructField("capacity_gw", DOUBLE),
            T.StructField("capacity_w_per_capita", DOUBLE),
        ]
    ),
}

GOLD_SCHEMAS = {
    "dim_date": T.StructType(
        [
            T.StructField("date", TIMESTAMP),
            T.StructField("year", LONG),
            T.StructField("quarter", LONG),
            T.StructField("month_number", LONG),
            T.StructField("month_name", STRING),
            T.StructField("year_month", STRING),
            T.StructField("is_complete_year", BOOLEAN),
        ]
    ),
    "dim_country": T.StructType(
        [
            T.StructField("entity_code", STRING),
            T.StructField("country_name", STRING),
            T.StructField("eu_member_flag", BOOLEAN),
        ]
    ),
    "dim_energy_series": T.StructType(
        [
            T.StructField("series_key", LONG),
            T.StructField("series_name", STRING),
            T.StructField("technology_group", STRING),
            T.StructField("energy_category", STRING),
            T.StructField("is_aggregate_series", BOOLEAN),
        ]
    ),
    "dim_capacity_series": T.StructType(
        [
            T.StructField("capacity_series_key", LONG),
            T.StructField("series_name", STRING),
            T.StructField("is_aggregate_series", BOOLEAN),
        ]
    ),
    "fact_generation": T.StructType(
        [
            T.StructField("date", TIMESTAMP),
            T.StructField("entity_code", STRING),
            T.StructField("series_key", LONG),
            T.StructField("generation_twh", DOUBLE),
            T.StructField("share_of_generation_pct", DOUBLE),
        ]
    ),
    "fact_emissions": T.StructType(
        [
            T.StructField("date", TIMESTAMP),
            T.StructField("entity_code", STRING),
            T.StructField("series_key", LONG),
            T.StructField("emissions_mtco2", DOUBLE),
            T.StructField("share_of_emissions_pct", DOUBLE),
        ]
    ),
    "fact_demand": T.StructType(
        [
            T.StructField("date", TIMESTAMP),
            T.StructField("entity_code", STRING),
            T.StructField("demand_twh", DOUBLE),
        ]
    ),
    "fact_carbon_intensity": T.StructType(
        [
            T.StructField("date", TIMESTAMP),
            T.StructField("entity_code", STRING),
            T.StructField("emissions_intensity_gco2_per_kwh", DOUBLE),
        ]
    ),
    "fact_capacity": T.StructType(
        [
            T.StructField("date", TIMESTAMP),
            T.StructField("entity_code", STRING),
            T.StructField("capacity_series_key", LONG),
            T.StructField("capacity_gw", DOUBLE),
            T.StructField("capacity_w_per_capita", DOUBLE),
        ]
    ),
}

# --- Fixed values: results depend on them, so they are stated as they are. ---

PROJECT_START = "2010-01"
BASELINE_YEAR = 2019
NET_IMPORTS = "Net imports"
TOTAL_GENERATION = "Total generation"
UNCLASSIFIED = "Unclassified"

PROJECT_COUNTRIES = [
    "AUT", "BEL", "BGR", "BIH", "BLR", "CHE", "CYP", "CZE", "DEU", "DNK",
    "ESP", "EST", "FIN", "FRA", "GBR", "GRC", "HRV", "HUN", "IRL", "ISL",
    "ITA", "LTU", "LUX", "LVA", "MDA", "MKD", "MLT", "MNE", "NLD", "NOR",
    "POL", "PRT", "ROU", "RUS", "SRB", "SVK", "SVN", "SWE", "TUR", "UKR",
    "XKX",
]

CAPACITY_COUNTRIES = [
    "BEL", "DEU", "DNK", "ESP", "FIN", "FRA", "GBR", "HUN", "ITA", "NLD",
    "POL", "PRT", "TUR",
]

# The membership flag covers these 17 codes only; other members are not listed.
EU_MEMBER_CODES = [
    "AUT", "BEL", "CZE", "DEU", "DNK", "ESP", "FIN", "FRA", "GRC", "HUN",
    "IRL", "ITA", "NLD", "POL", "PRT", "ROU", "SWE",
]

# (series, technology group, energy category)
SERIES_CLASSIFICATION = (
    ("Bioenergy", "Bioenergy", "Renewable"),
    ("Coal", "Coal", "Fossil"),
    ("Gas", "Gas", "Fossil"),
    ("Hydro", "Hydro", "Renewable"),
    ("Nuclear", "Nuclear", "Clean"),
    ("Solar", "Solar", "Renewable"),
    ("Wind", "Wind", "Renewable"),
    ("Onshore wind", "Wind", "Renewable"),
    ("Offshore wind", "Wind", "Renewable"),
    ("Unknown wind", "Wind", "Renewable"),
    ("Other renewables", "Other renewables", "Renewable"),
    ("Other fossil", "Other fossil", "Fossil"),
    ("Net imports", "Net imports", "Flow"),
    ("Clean", "Clean", "Aggregate"),
    ("Fossil", "Fossil", "Aggregate"),
    ("Renewables", "Renewables", "Aggregate"),
    ("Wind and solar", "Wind and solar", "Aggregate"),
    ("Hydro, bioenergy and other renewables", "Hydro/bioenergy/other renewables", "Aggregate"),
    ("Total generation", "Total generation", "Aggregate"),
    ("Demand", "Demand", "System metric"),
)


def require_dataset(name: str) -> str:
    """Reject names outside the five datasets before any plan is built."""
    if name not in DATASETS:
        raise ValueError(f"unknown dataset {name!r}; expected one of {sorted(DATASETS)}")
    return name


def silver_columns(name: str) -> list[str]:
    """Every column a typed dataset carries, in declared order."""
    return SILVER_SCHEMAS[require_dataset(name)].fieldNames()
