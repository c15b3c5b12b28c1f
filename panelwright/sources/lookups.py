"""Inline lookup relations (S10). Users may pass tables of the same columns instead."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Keyword -> clean variable name, tried in this order.
VARIABLE_KEYWORDS = [
    ("SDG 6.4.2. Water Stress", "sdg642_water_stress_pct"),
    ("Total renewable water resources", "total_renewable_water_km3"),
    ("Total water withdrawal", "total_water_withdrawal_km3"),
    ("Agricultural water withdrawal", "agricultural_withdrawal_km3"),
    ("Industrial water withdrawal", "industrial_withdrawal_km3"),
    ("Municipal water withdrawal", "municipal_withdrawal_km3"),
    ("Total renewable water resources per capita", "renewable_water_per_capita"),
    ("Precipitation", "precipitation_mm"),
    ("Dependency ratio", "dependency_ratio_pct"),
    ("Total dam capacity", "dam_capacity_km3"),
    ("Flood occurrence", "flood_occurrence"),
    ("Drought occurrence", "drought_occurrence"),
    ("National Rainfall Index", "rainfall_index"),
    ("Total population with access to safe drinking-water", "safe_water_access_pct"),
]

# Raw -> working column names of the static indicator table.
STATIC_RENAMES = {
    "name_0": "country", "gid_0": "country_code",
    "bws_raw": "water_stress_raw", "bws_score": "water_stress_score",
    "bws_cat": "water_stress_category", "bws_label": "water_stress_label",
    "bwd_raw": "water_depletion_raw", "bwd_score": "water_depletion_score",
    "iav_score": "interannual_variability", "sev_score": "seasonal_variability",
    "gtd_score": "groundwater_decline_score",
    "drr_raw": "drought_risk_raw", "drr_score": "drought_risk_score",
    "rfr_score": "flood_risk_score",
    "w_awr_def_tot_raw": "overall_water_risk_raw",
    "w_awr_def_tot_score": "overall_water_risk",
}

# Names of the annual table's columns, by position.
ANNUAL_COLUMNS = ["variable_id", "variable", "area_id", "country", "year_id", "year", "value"]

# Provenance tags of the three sources.
STATIC_SOURCE = "WRI_Aqueduct_4.0"
ANNUAL_SOURCE = "FAO_AQUASTAT"
MONTHLY_SOURCE = "NASA_GRACE"

# Composite score weights.
SCORE_WEIGHTS = {
    "water_stress_score": 0.25,
    "drought_risk_score": 0.25,
    "tws_score_norm": 0.3,
    "groundwater_decline_score": 0.2,
}

# Entity points (code, name, latitude, longitude).
ENTITY_POINTS = [
    ("AFG", "Afghanistan", 33.9, 67.7), ("DZA", "Algeria", 28.0, 1.7),
    ("AGO", "Angola", -11.2, 17.9), ("ARG", "Argentina", -38.4, -63.6),
    ("AUS", "Australia", -25.3, 133.8), ("BGD", "Bangladesh", 23.7, 90.3),
    ("BFA", "Burkina Faso", 12.3, -1.6), ("BRA", "Brazil", -14.0, -51.0),
    ("CAN", "Canada", 56.1, -106.3), ("TCD", "Chad", 15.5, 18.7),
    ("CHL", "Chile", -35.7, -71.5), ("CHN", "China", 35.0, 105.0),
    ("COL", "Colombia", 4.6, -74.3), ("COD", "DR Congo", -4.0, 21.8),
    ("CIV", "Ivory Coast", 7.5, -5.5), ("EGY", "Egypt", 26.8, 30.8),
    ("ETH", "Ethiopia", 9.1, 40.5), ("FRA", "France", 46.2, 2.2),
    ("DEU", "Germany", 51.2, 10.4), ("GHA", "Ghana", 7.9, -1.0),
    ("IND", "India", 20.6, 79.0), ("IDN", "Indonesia", -5.0, 120.0),
    ("IRN", "Iran", 32.4, 53.7), ("IRQ", "Iraq", 33.2, 43.7),
    ("ISR", "Israel", 31.0, 34.9), ("ITA", "Italy", 41.9, 12.6),
    ("JPN", "Japan", 36.2, 138.2), ("JOR", "Jordan", 30.6, 36.2),
    ("KEN", "Kenya", -0.02, 37.9), ("KWT", "Kuwait", 29.3, 47.5),
    ("LBY", "Libya", 26.3, 17.2), ("MDG", "Madagascar", -18.8, 47.0),
    ("MYS", "Malaysia", 4.2, 101.9), ("MLI", "Mali", 17.6, -4.0),
    ("MAR", "Morocco", 31.8, -7.1), ("MOZ", "Mozambique", -18.7, 35.5),
    ("MMR", "Myanmar", 19.8, 96.2), ("NPL", "Nepal", 28.4, 84.1),
    ("NER", "Niger", 17.6, 8.1), ("NGA", "Nigeria", 9.0, 8.0),
    ("OMN", "Oman", 21.5, 55.9), ("PAK", "Pakistan", 30.0, 69.0),
    ("PER", "Peru", -9.2, -75.0), ("PHL", "Philippines", 12.9, 121.8),
    ("POL", "Poland", 51.9, 19.1), ("ROU", "Romania", 45.9, 25.0),
    ("RUS", "Russia", 61.5, 105.0), ("SAU", "Saudi Arabia", 23.9, 45.1),
    ("SEN", "Senegal", 14.5, -14.5), ("SOM", "Somalia", 5.2, 46.2),
    ("ZAF", "South Africa", -30.6, 22.9), ("KOR", "South Korea", 35.9, 128.0),
    ("ESP", "Spain", 40.5, -3.7), ("SDN", "Sudan", 12.9, 30.2),
    ("SYR", "Syria", 34.8, 38.0), ("TZA", "Tanzania", -6.4, 34.9),
    ("THA", "Thailand", 15.9, 100.9), ("TUN", "Tunisia", 33.9, 9.5),
    ("TUR", "Turkey", 38.9, 35.2), ("UGA", "Uganda", 1.4, 32.3),
    ("UKR", "Ukraine", 48.4, 31.2), ("ARE", "UAE", 23.4, 53.8),
    ("GBR", "United Kingdom", 55.4, -3.4), ("USA", "United States", 38.0, -97.0),
    ("VEN", "Venezuela", 6.4, -66.6), ("VNM", "Vietnam", 14.1, 108.3),
    ("YEM", "Yemen", 15.6, 48.5), ("ZMB", "Zambia", -13.1, 27.8),
    ("ZWE", "Zimbabwe", -20.0, 30.0), ("MEX", "Mexico", 23.6, -102.5),
    ("CMR", "Cameroon", 7.4, 12.4), ("LBN", "Lebanon", 33.9, 35.8),
]

# Country name as found in the annual table -> ISO-3 code.
NAME_TO_CODE = {
    "Afghanistan": "AFG", "Algeria": "DZA", "Angola": "AGO", "Argentina": "ARG",
    "Australia": "AUS", "Bangladesh": "BGD", "Bolivia (Plurinational State of)": "BOL",
    "Brazil": "BRA", "Burkina Faso": "BFA", "Cameroon": "CMR", "Canada": "CAN",
    "Chad": "TCD", "Chile": "CHL", "China": "CHN", "Colombia": "COL", "Congo": "COG",
    "Côte d'Ivoire": "CIV", "Democratic Republic of the Congo": "COD", "Egypt": "EGY",
    "Ethiopia": "ETH", "France": "FRA", "Germany": "DEU", "Ghana": "GHA", "India": "IND",
    "Indonesia": "IDN", "Iran (Islamic Republic of)": "IRN", "Iraq": "IRQ", "Israel": "ISR",
    "Italy": "ITA", "Japan": "JPN", "Jordan": "JOR", "Kenya": "KEN", "Kuwait": "KWT",
    "Lao People's Democratic Republic": "LAO", "Lebanon": "LBN", "Libya": "LBY",
    "Madagascar": "MDG", "Malaysia": "MYS", "Mali": "MLI", "Mexico": "MEX",
    "Morocco": "MAR", "Mozambique": "MOZ", "Myanmar": "MMR", "Nepal": "NPL",
    "Niger": "NER", "Nigeria": "NGA", "Oman": "OMN", "Pakistan": "PAK", "Peru": "PER",
    "Philippines": "PHL", "Poland": "POL", "Romania": "ROU", "Russian Federation": "RUS",
    "Saudi Arabia": "SAU", "Senegal": "SEN", "Somalia": "SOM", "South Africa": "ZAF",
    "Korea, Republic of": "KOR", "Spain": "ESP", "Sudan": "SDN",
    "Syrian Arab Republic": "SYR", "Tanzania, United Republic of": "TZA",
    "Thailand": "THA", "Tunisia": "TUN", "Türkiye": "TUR", "Turkey": "TUR",
    "Uganda": "UGA", "Ukraine": "UKR", "United Arab Emirates": "ARE",
    "United Kingdom of Great Britain and Northern Ireland": "GBR",
    "United States of America": "USA", "Venezuela (Bolivarian Republic of)": "VEN",
    "Viet Nam": "VNM", "Yemen": "YEM", "Zambia": "ZMB", "Zimbabwe": "ZWE",
    "Iran": "IRN", "Russia": "RUS", "United Kingdom": "GBR", "United States": "USA",
    "Venezuela": "VEN", "Vietnam": "VNM", "South Korea": "KOR", "Syria": "SYR",
    "Tanzania": "TZA", "Bolivia": "BOL", "Laos": "LAO", "Burma": "MMR",
    "Ivory Coast": "CIV", "Cuba": "CUB",
}


def _fixed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of this file: a few dozen rows, whatever the data, so always broadcast."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def entity_points(spark: SparkSession) -> DataFrame:
    return _fixed(spark, ENTITY_POINTS, "country_code string, country string, lat double, lon double")


def name_codes(spark: SparkSession) -> DataFrame:
    return _fixed(spark, list(NAME_TO_CODE.items()), "name string, code string")


def keyword_list(spark: SparkSession) -> DataFrame:
    rows = [(i, word, name) for i, (word, name) in enumerate(VARIABLE_KEYWORDS)]
    return _fixed(spark, rows, "priority int, keyword string, clean_name string")
