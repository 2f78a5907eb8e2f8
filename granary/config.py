"""Rules of the lead jobs: one frozen value, passed to the operators that need it."""

from __future__ import annotations

from dataclasses import dataclass

# Source weights, label rules, lender names, customer profile. They must equal the rules of the data they score.
SOURCE_WEIGHTS = {"HTML_TABLE": 40, "PDF_TEXT": 25, "OCR": 10}
LABEL_RULES = (
    ("^kortfristiga skulder", "Summa Kortfristiga Skulder"),
    ("^långfristiga skulder", "Summa Långfristiga Skulder"),
    ("^(nettoomsättning|omsättning|rörelsens intäkter)", "Omsättning"),
    ("^rörelseresultat", "Rörelseresultat"),
    ("^(årets resultat|resultat efter skatt)", "Årets Resultat"),
    ("^balansomslutning|^summa tillgångar", "Balansomslutning"),
)
LENDERS = ("Kreditinstitut", "Qred", "Froda", "CapitalBox", "Capital Box", "Svea", "OPR", "Capcito", "Almi", "Nordea Finans", "Handelsbanken Finans", "SEB Finans", "Swedbank Finans", "Resurs Bank", "Marginalen", "Collector", "DBT", "Treyd", "Corpia", "Fakturino")
CORE_BRANCHES = ("bygg", "konstruktion", "handel", "fordon", "bilverk", "bilservice", "juridik", "advokat", "ekonomi", "redovisning", "revision", "konsult")
SECONDARY_BRANCHES = ("transport", "åkeri", "logistik", "hotell", "restaurang", "café", "kafé", "livsmedel", "tillverk", "industri", "snickeri", "vvs", "el-?install", "måleri")
FIGURE_RULES = {
    "revenue": "^(nettoomsättning|omsättning|rörelsens intäkter)",
    "operating_result": "^rörelseresultat",
    "net_result": "^(årets resultat|resultat efter skatt)",
    "short_debt": "^kortfristiga skulder",
    "long_debt": "^långfristiga skulder",
}


@dataclass(frozen=True)
class Rules:
    as_of_year: int = 2026
    multiplier: int = 1000
    sanity_limit: int = 5_000_000_000
    revenue_min: int = 3_000_000
    revenue_max: int = 8_000_000
    revenue_soft_max: int = 15_000_000
    employees_min: int = 2
    employees_max: int = 4
    employees_soft_max: int = 10
    age_min: int = 8
    age_preferred: int = 10
    debt_cap: int = 50_000_000
    lenders: tuple[str, ...] = LENDERS
    label_rules: tuple[tuple[str, str], ...] = LABEL_RULES


RULES = Rules()
