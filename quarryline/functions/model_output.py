"""Strict validation of JSON written by a query rewriter, as Column expressions on VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*|BOOLEAN)$"


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def parsed_query(raw: Column) -> Column:
    """STRUCT<refined_query, filters, must_not, confidence>, or NULL unless ``raw`` is exactly one valid object.

    The text is parsed inside brackets and must give one element, which rejects anything after the object.
    ``filters`` (string to string) and ``must_not`` (strings) may be missing but not null; ``confidence`` may be
    missing, null, a number, a numeric string or a boolean (1 or 0).
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    value = F.try_variant_get(wrapped, "$[0]", "variant")
    alone = F.try_variant_get(wrapped, "$[1]", "variant").isNull()

    def part(name: str) -> Column:
        return F.try_variant_get(value, f"$.{name}", "variant")

    text = part("refined_query")
    filters = F.try_variant_get(value, "$.filters", "map<string,variant>")
    must_not = F.try_variant_get(value, "$.must_not", "array<variant>")
    confidence = part("confidence")
    as_bool = F.when(_kind(confidence) == "BOOLEAN", F.try_variant_get(value, "$.confidence", "boolean").cast("double"))
    as_number = F.coalesce(as_bool, F.try_variant_get(value, "$.confidence", "double"))

    def all_text(items: Column) -> Column:
        return F.forall(items, lambda item: F.coalesce(_kind(item) == "STRING", F.lit(False)))

    ok = (
        alone
        & _kind(value).startswith("OBJECT")
        & (_kind(text) == "STRING")
        & (part("filters").isNull() | (filters.isNotNull() & all_text(F.map_values(filters))))
        & (part("must_not").isNull() | (must_not.isNotNull() & all_text(must_not)))
        & (
            confidence.isNull()
            | (_kind(confidence) == "VOID")
            | (_kind(confidence).rlike(_NUMBER) | (_kind(confidence) == "STRING")) & as_number.isNotNull()
        )
    )
    strings = F.transform(must_not, lambda item: F.try_variant_get(item, "$", "string"))
    string_map = F.transform_values(filters, lambda _, item: F.try_variant_get(item, "$", "string"))
    no_filters = F.create_map().cast("map<string,string>")
    result = F.struct(
        F.try_variant_get(value, "$.refined_query", "string").alias("refined_query"),
        F.coalesce(string_map, no_filters).alias("filters"),
        F.coalesce(strings, F.array().cast("array<string>")).alias("must_not"),
        as_number.alias("confidence"),
    )
    return F.when(F.coalesce(ok, F.lit(False)), result)
