"""Rule books for raw and cleaned tables, derived from the declarations.

What a table's jobs rely on is what gets checked: required columns must be filled and
keys must be unique. Other tables can be given as rows (``rules_from_table``) and
merged with ``{**bronze_rules(), **more}``.
"""

from __future__ import annotations

import re

from tarnlake.operators.cleaning import CleanSpec
from tarnlake.operators.rules import Rule, rules_from_specs
from tarnlake.plans.clean_tables import SPECS
from tarnlake.plans.dims import DIMENSIONS
from tarnlake.plans.facts import FACT_KEYS

# Documents that no declared table reads by column.
DOCUMENTS = {
    "api_currencies": Rule(("CurrencyDate", "data"), ("CurrencyDate",)),
    "api_geocoding": Rule(("country", "name", "lat", "lon"), ("name",)),
    "api_weather_historical": Rule(("latitude", "longitude", "daily")),
    "api_weather_latest": Rule(("latitude", "longitude", "daily")),
}

# Required columns and keys of raw tables that no cleaned table reads.
UNREAD = {
    "humanresources_jobcandidate": Rule(("JobCandidateID",), ("JobCandidateID",)),
    "person_password": Rule(("BusinessEntityID", "PasswordHash", "PasswordSalt"), ("BusinessEntityID",)),
    "production_culture": Rule(("Name",)),
    "production_illustration": Rule(("IllustrationID",), ("IllustrationID",)),
    "production_productdescription": Rule(("ProductDescriptionID",), ("ProductDescriptionID",)),
    "production_productmodelillustration": Rule(("ProductModelID", "IllustrationID"), ("ProductModelID",)),
    "production_productmodelproductdescriptionculture": Rule(
        ("ProductModelID", "ProductDescriptionID"), ("ProductDescriptionID",)),
    "production_productphoto": Rule(("ProductPhotoID",), ("ProductPhotoID",)),
    "production_productproductphoto": Rule(("ProductID", "ProductPhotoID"), ("ProductPhotoID",)),
    "production_productreview": Rule(("ProductReviewID", "ProductID", "ReviewDate", "Rating"), ("ProductReviewID",)),
    "production_workorderrouting": Rule(
        ("WorkOrderID", "ProductID", "LocationID", "ActualStartDate", "ActualCost"), ("WorkOrderID",)),
    "sales_countryregioncurrency": Rule(("CountryRegionCode", "CurrencyCode"), ("CountryRegionCode",)),
    "sales_creditcard": Rule(("CreditCardID", "CardType", "CardNumber"), ("CreditCardID",)),
    "sales_personcreditcard": Rule(("BusinessEntityID", "CreditCardID"), ("CreditCardID",)),
    "sales_salesorderheadersalesreason": Rule(
        ("SalesOrderID", "SalesReasonID"), (("SalesOrderID", "SalesReasonID"),)),
    "sales_salesperson": Rule(
        ("BusinessEntityID", "Bonus", "CommissionPct", "SalesYTD", "SalesLastYear"), ("BusinessEntityID",)),
    "sales_salesreason": Rule(("SalesReasonID", "Name", "ReasonType"), ("SalesReasonID",)),
    "sales_salestaxrate": Rule(("SalesTaxRateID", "StateProvinceID", "TaxType", "TaxRate"), ("SalesTaxRateID",)),
    "sales_shoppingcartitem": Rule(
        ("ShoppingCartItemID", "ShoppingCartID", "Quantity", "ProductID", "DateCreated"), ("ShoppingCartItemID",)),
}

_BASE_COLUMN = re.compile(r"\bb\.(\w+)")


def _key(columns: list[str]) -> tuple[str | tuple[str, ...], ...]:
    if not columns:
        return ()
    return (columns[0],) if len(columns) == 1 else (tuple(columns),)


def _raw_columns(spec: CleanSpec, part, names) -> list[str]:
    found = [_BASE_COLUMN.search(part.columns[n]) for n in names]
    return list(dict.fromkeys(f.group(1) for f in found if f))


def bronze_rules() -> dict[str, Rule]:
    """Raw tables: columns behind required columns, keys behind keys, and the columns
    lookups are joined on."""
    book: dict[str, Rule] = {**DOCUMENTS, **UNREAD}
    for spec in SPECS.values():
        for part in spec.parts:
            for lk in part.lookups:
                column = re.search(rf"\b{lk.alias}\.(\w+)", lk.on).group(1)
                book.setdefault(lk.table, Rule((column,), (column,)))
    for spec in SPECS.values():
        for part in spec.parts:
            filled, unique = (_raw_columns(spec, part, n) for n in (spec.required, spec.keys))
            book[part.table] = Rule(tuple(filled), _key(unique))
    return book


def silver_rules() -> dict[str, Rule]:
    """Cleaned tables, dimensions and facts."""
    book = rules_from_specs(SPECS.values())
    for name, d in DIMENSIONS.items():
        book[name] = Rule((d.sk, *d.keys), (d.sk, *_key(list(d.keys))))
    book["dim_date"] = Rule(("FullDate",), ("FullDate",))
    for name, keys in FACT_KEYS.items():
        book[name] = Rule(tuple(keys), _key(list(keys)))
    return book
