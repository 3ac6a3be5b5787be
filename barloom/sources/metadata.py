"""Instrument metadata: maps of strings in, typed columns out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(c: Column) -> Column:
    """A trimmed string, NULL if blank."""
    return F.nullif(F.trim(c), F.lit(""))


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(w.capitalize() for w in rest)


def decode(c: Column, kind: str) -> Column:
    """A string as int, float, bool, list, dict or str; NULL where it isn't one."""
    v = present(c)
    if kind == "bool":
        number = v.try_cast("double")
        return F.when(number.isNotNull(), number == 1.0).when(v.isNotNull(), F.lower(v).isin("true", "yes"))
    if kind in ("int", "float"):
        return v.try_cast({"int": "bigint", "float": "double"}[kind])
    if kind == "list":
        return F.from_json(F.translate(v, "'", '"'), "array<string>")
    if kind == "dict":
        return F.from_json(F.translate(v, "'", '"'), "map<string,string>")
    return v


def typed(rows: DataFrame, fields: dict[str, str], column: str = "info") -> DataFrame:
    """Rows with a map of camel-case names -> a typed snake-case column for each of fields (name -> kind)."""
    return rows.select(*[c for c in rows.columns if c != column], *(decode(F.col(column)[camel(n)], k).alias(n) for n, k in fields.items()))


def describe(rows: DataFrame, column: str = "info", default_currency: str = "USD", default_exchange: str = "NMS") -> DataFrame:
    """(symbol, name, type, sector, industry, currency, exchange): the first of several names that each may have."""
    got = lambda *names: F.coalesce(*(present(F.col(column)[n]) for n in names))
    return rows.select(
        "symbol",
        got("displayName", "shortName", "longName").alias("name"),
        got("quoteType", "typeDisp").alias("type"),
        got("sectorDisp", "sector", "sectorKey").alias("sector"),
        got("industryDisp", "industry", "industryKey").alias("industry"),
        F.coalesce(got("currency", "financialCurrency"), F.lit(default_currency)).alias("currency"),
        F.coalesce(got("exchange", "fullExchangeName"), F.lit(default_exchange)).alias("exchange"),
    )
