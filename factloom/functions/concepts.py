"""Tags of financial facts mapped to canonical concepts; of several tags for one concept the lowest preference wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Canonical concept, taxonomy, tag, preference, unit class.
CONCEPTS = (
    ("revenue_total", "us-gaap", "RevenueFromContractWithCustomerExcludingAssessedTax", 10, "monetary"),
    ("revenue_total", "us-gaap", "RevenueFromContractWithCustomerIncludingAssessedTax", 20, "monetary"),
    ("revenue_total", "us-gaap", "Revenues", 30, "monetary"),
    ("revenue_total", "us-gaap", "SalesRevenueNet", 40, "monetary"),
    ("net_income", "us-gaap", "NetIncomeLoss", 10, "monetary"),
    ("net_income", "us-gaap", "ProfitLoss", 20, "monetary"),
    ("operating_income", "us-gaap", "OperatingIncomeLoss", 10, "monetary"),
    ("gross_profit", "us-gaap", "GrossProfit", 10, "monetary"),
    ("assets_total", "us-gaap", "Assets", 10, "monetary"),
    ("liabilities_total", "us-gaap", "Liabilities", 10, "monetary"),
    ("equity_total", "us-gaap", "StockholdersEquity", 10, "monetary"),
    ("equity_total", "us-gaap", "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest", 20, "monetary"),
    ("cash_and_equivalents", "us-gaap", "CashAndCashEquivalentsAtCarryingValue", 10, "monetary"),
    ("eps_basic", "us-gaap", "EarningsPerShareBasic", 10, "per_share"),
    ("eps_diluted", "us-gaap", "EarningsPerShareDiluted", 10, "per_share"),
    ("shares_outstanding", "dei", "EntityCommonStockSharesOutstanding", 10, "shares"),
)
#: Preference of a tag that no row names.
UNRANKED = 9999


def lookup(pairs: dict[str, object], key: Column) -> Column:
    """Value of a small literal map; NULL for a key that is not in it."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]), key)


def canonical_concept(taxonomy: Column, tag: Column, concepts=CONCEPTS) -> Column:
    return lookup({f"{t}|{g}": c for c, t, g, *_ in concepts}, F.concat_ws("|", taxonomy, tag))


def tag_preference(taxonomy: Column, tag: Column, concepts=CONCEPTS) -> Column:
    """Lower is better.  A tag of the same name in another taxonomy, such as a company's own, is unranked."""
    return F.coalesce(lookup({f"{t}|{g}": p for _, t, g, p, *_ in concepts}, F.concat_ws("|", taxonomy, tag)), F.lit(UNRANKED))


def mappings_for(taxonomy: str, tag: str, concepts=CONCEPTS) -> list[tuple]:
    return [c for c in concepts if c[1:3] == (taxonomy, tag)]


def tags_to_fetch(concepts=CONCEPTS) -> list[tuple[str, str]]:
    return [(t, g) for _, t, g, *_ in concepts]
