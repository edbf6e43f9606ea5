"""Curated CPI tiers, kept as data (a small DataFrame), not code.

Fixed values: the series names below must equal the published tier lists exactly (order as given).
Tier 1 headline/core (15), tier 2 main categories (10), tier 3 subcategories (88).
"""
from __future__ import annotations

# Fixed values — tier 1, headline and core.
HEADLINE_CORE = [
    "CPI - All items",
    "CPI - All items, seasonally adjusted",
    "CPI - All items, less fresh food",
    "CPI - All items, less fresh food, seasonally adjusted",
    "CPI - All items, less fresh food and energy",
    "CPI - All items, less fresh food and energy, seasonally adjusted",
    "CPI - All items, less food (less alcoholic beverages) and energy",
    "CPI - All items, less food (less alcoholic beverages) and energy, seasonally adjusted",
    "CPI - All items, less imputed rent",
    "CPI - All items, less imputed rent & fresh food",
    "CPI - Core - all items, less food (less alcoholic beverages) and energy, sa by JPM",
    "CPI Tokyo - All items",
    "CPI Tokyo - All items, less fresh food",
    "CPI Tokyo - All items, less fresh food and energy",
    "CPI Tokyo - All items, seasonally adjusted",
]

# Fixed values — tier 2, the ten top-level categories.
MAIN_CATEGORIES = [
    "CPI - Food",
    "CPI - Housing",
    "CPI - Fuel, light & water charges",
    "CPI - Furniture & household utensils",
    "CPI - Clothes & footwear",
    "CPI - Medical care",
    "CPI - Transportation & communication",
    "CPI - Education",
    "CPI - Culture & recreation",
    "CPI - Miscellaneous",
]

# Fixed values — tier 3, middle and small groups.
SUBCATEGORIES = [
    "CPI - Cereals", "CPI - Fresh fish & seafood", "CPI - Fish & seafood",
    "CPI - Salted & dried fish", "CPI - Fish-paste products",
    "CPI - Other processed fish & seafood",
    "CPI - Raw meats", "CPI - Seasoned meat", "CPI - Meats",
    "CPI - Fresh milk & dairy products", "CPI - Dairy products & eggs",
    "CPI - Vegetables & seaweeds", "CPI - Fresh vegetables",
    "CPI - Processed vegetables & seaweeds",
    "CPI - Fruits", "CPI - Fresh fruits", "CPI - Processed fruits",
    "CPI - Oils, fats & seasonings", "CPI - Cakes & candies", "CPI - Cooked food",
    "CPI - Beverages", "CPI - Alcoholic beverages",
    "CPI - Meals outside the home", "CPI - Eating out", "CPI - School lunch",
    "CPI - Rent", "CPI - Imputed rent",
    "CPI - Repairs & maintenance",
    "CPI - Service charges for repairs & maintenance",
    "CPI - Tools & materials for repairs & maintenance",
    "CPI - Electricity", "CPI - Gas",
    "CPI - Gas, manufactured & piped", "CPI - Liquefied propane",
    "CPI - Other fuel & light",
    "CPI - Water & sewerage charges", "CPI - Water charges",
    "CPI - Durable goods", "CPI - Domestic non-durable goods",
    "CPI - Other domestic non-durable goods",
    "CPI - Interior furnishings", "CPI - Bedding", "CPI - Domestic utensils",
    "CPI - Domestic services", "CPI - Durable goods assisting housework",
    "CPI - Clothing", "CPI - Children's clothing", "CPI - Women's clothing",
    "CPI - Japanese clothing", "CPI - Shirts, sweaters & underwear",
    "CPI - Footwear", "CPI - Other clothing",
    "CPI - Services related to clothing",
    "CPI - Medicines & health fortification",
    "CPI - Medical supplies & appliances", "CPI - Medical services",
    "CPI - Automobiles", "CPI - Automotive maintenance",
    "CPI - Public transportation", "CPI - Private transportation",
    "CPI - Communication", "CPI - Gasoline",
    "CPI - School fees", "CPI - School textbooks",
    "CPI - School textbooks & reference books for study",
    "CPI - Tutorial fees", "CPI - After-school childcare fees",
    "CPI - Recreational goods", "CPI - Recreational durable goods",
    "CPI - Books & other reading materials", "CPI - Recreational services",
    "CPI - Personal care services", "CPI - Personal effects",
    "CPI - Tobacco", "CPI - Funeral fees",
    "CPI - Energy", "CPI - Goods", "CPI - Services",
    "CPI - Food, less fresh food", "CPI - Goods, less fresh food",
    "CPI - Housing, less imputed rent", "CPI - Services, less imputed rent",
    "CPI - Agricultural, aquatic & livestock products",
    "CPI - Industrial products",
    "CPI - Public services", "CPI - General services",
    "CPI - Semi-durable goods", "CPI - Fresh food",
]

# Fixed values — tier parameters: (tier, series list, dataset regex or None).
TIERS = [
    ("headline_core", HEADLINE_CORE, None),
    ("main_categories", MAIN_CATEGORIES, "Japan"),
    ("subcategories", SUBCATEGORIES, "Japan"),
]
# Fixed values — the all-items tier is derived from the catalog with these filters.
ALL_ITEMS_DATASET = "Consumer Price Index - Japan"
ALL_ITEMS_PREFIX = "CPI - "
ALL_ITEMS_REGEX = "Japan"

ALL_CURATED = HEADLINE_CORE + MAIN_CATEGORIES + SUBCATEGORIES


def tier_rows() -> list[tuple[str, str, int, str | None]]:
    """(tier, series, request position, dataset regex) for the three curated tiers."""
    return [(t, s, i, rx) for t, names, rx in TIERS for i, s in enumerate(names, 1)]
