"""Documents held in table columns -> flat tables (PIP-1, PIP-2).

One narrow stage each: parse, unnest the repeating element, project. A
document that does not parse is refused: the plain functions fail the run on
it, as a cast to JSON or XML does; the loads put it aside with its text,
counted in the pass that parses (``weir.sinks.rejects``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir import schemas
from weir.functions.docs import json_text_nonempty
from weir.operators.contract import conform
from weir.sinks import rejects
from weir.sinks.tables import append_held
from weir.sources.files import CORRUPT, is_text, parse_json_column, parse_xml_tree, plain_text

# ---- pets --------------------------------------------------------------------


def marked_pets(raw_json: DataFrame, col: str = "json_data") -> DataFrame:
    """One row per element of ``pets`` (documents without it give no row), and
    one row with ``_reason`` and ``_record`` per document that does not parse.
    ``fav_foods`` is JSON text, NULL when absent or empty; ``birth_year`` is an
    integer, NULL when empty (JSN-1..3, NUL-3, ARR-2)."""
    docs = parse_json_column(raw_json, col, schemas.PETS_DOC)
    # only text that the typed parse stumbled over is looked at again: it is
    # malformed if it is no JSON, or if its pets are no array; other values of
    # an unexpected type read as NULL
    value = F.try_parse_json(F.col(col))
    pets_given = F.try_variant_get(value, "$.pets", "variant").isNotNull() & ~F.is_variant_null(F.try_variant_get(value, "$.pets", "variant"))
    no_array = pets_given & F.try_variant_get(value, "$.pets", "array<variant>").isNull()
    stumbled = F.col("doc").isNull() | F.col(f"doc.{CORRUPT}").isNotNull()
    bad = F.when(F.col(col).isNotNull() & stumbled, value.isNull() | F.coalesce(no_array, F.lit(False))).otherwise(F.lit(False))
    # a refused document has one row without a pet
    pets = F.when(bad, F.array(F.lit(None))).otherwise(F.col("doc.pets"))
    rows = docs.select(bad.alias("_bad"), F.col(col).alias("_text"), F.explode(pets).alias("p"))
    flat = rows.select(
        F.col("p.name").alias("name"),
        F.col("p.species").alias("species"),
        json_text_nonempty("p.favFoods").alias("fav_foods"),
        F.nullif(F.col("p.birthYear"), F.lit("")).cast("int").alias("birth_year"),
        F.col("p.photo").alias("photo"),
        "_bad",
        "_text",
    )
    return rejects.mark(flat, F.when(F.col("_bad"), rejects.MALFORMED), F.col("_text")).drop("_bad", "_text")


def _strict(marked: DataFrame, what: str) -> DataFrame:
    """The rows of a marked frame; a refused record fails the run."""
    fine = F.when(F.col(rejects.REASON).isNull(), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit(f"{what}: "), F.col(rejects.REASON), F.lit(": "), F.left(F.col(rejects.RECORD), F.lit(200)))).cast("boolean")
    )
    return marked.where(fine).drop(rejects.REASON, rejects.RECORD)


def flat_pets(raw_json: DataFrame, col: str = "json_data") -> DataFrame:
    """The pets of ``marked_pets``; a malformed document fails the run."""
    return _strict(marked_pets(raw_json, col), "pets")


# ---- foods -------------------------------------------------------------------


def descendants(tree: Column, name: str, depth: Column) -> Column:
    """All elements called ``name`` at any depth of a parsed document, as an
    array of VARIANT (XPath ``//name``), without leaving the row.

    The document is walked level by level: a level's children are the entries
    of its objects, those of an array being one child each. ``depth`` is a
    bound of the document's depth; the walk ends early, at the first level
    without children.
    """
    entry = "struct<name: string, value: variant>"

    def children(e: Column) -> Column:
        fields = F.map_entries(F.try_variant_get(e["value"], "$", "map<string,variant>"))
        named = F.transform(fields, lambda x: F.struct(x["key"].alias("name"), x["value"].alias("value")))
        return F.coalesce(named, F.array().cast(f"array<{entry}>"))

    def siblings(e: Column) -> Column:
        many = F.try_variant_get(e["value"], "$", "array<variant>")
        each = F.transform(many, lambda v: F.struct(e["name"].alias("name"), v.alias("value")))
        return F.coalesce(each, F.array(F.struct(e["name"].alias("name"), e["value"].alias("value"))))

    def step(acc: Column, _: Column) -> Column:
        level = F.flatten(F.transform(F.flatten(F.transform(acc["at"], children)), siblings))
        # the level is computed once, as the value of a one-element array
        below = F.transform(
            F.array(level),
            lambda found: F.struct(
                found.alias("at"), F.concat(acc["found"], F.filter(found, lambda e: e["name"] == name)).alias("found")
            ),
        )
        return F.when(F.size(acc["at"]) == 0, acc).otherwise(F.element_at(below, 1))

    none = F.array().cast(f"array<{entry}>")
    start = F.struct(F.array(F.struct(F.lit("").alias("name"), tree.alias("value"))).alias("at"), none.alias("found"))
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), depth))
    return F.transform(F.aggregate(steps, start, step)["found"], lambda e: e["value"])


def _first_text(s: Column) -> Column:
    """The text of an element, or of the first of several; NULL without text.
    A plain text is marked as such; an element with attributes, and several
    elements, are JSON."""
    of_object = F.get_json_object(s, "$._VALUE")
    of_array = F.coalesce(F.get_json_object(s, "$[0]._VALUE"), F.get_json_object(s, "$[0]"))
    text = F.when(is_text(s), s).when(s.startswith("{"), of_object).when(s.startswith("["), of_array)
    return F.nullif(F.when(is_text(text), plain_text(text)), F.lit(""))


def _first_of(s: Column, name: str) -> Column:
    """A child or attribute of an element, or of the first of several."""
    return F.when(s.startswith("{"), F.get_json_object(s, f"$.{name}")).when(s.startswith("["), F.get_json_object(s, f"$[0].{name}"))


#: The children of a food that are read.
_PARTS = (
    "name", "mfr", "serving", "calories", "total-fat", "saturated-fat", "cholesterol", "sodium", "carb", "fiber", "protein",
    "vitamins", "minerals",
)


def marked_foods(raw_xml: DataFrame, col: str = "xml_data") -> DataFrame:
    """One row per ``food`` element at any depth; text fields as text, calorie
    attributes as integers (empty -> NULL), missing vitamins/minerals -> '0'
    (XML-1..4, NUL-1, NUL-2); one row with ``_reason`` and ``_record`` per
    document that does not parse."""
    docs = parse_xml_tree(raw_xml, col)
    # a document is one root element, with nothing beside it
    root = F.map_values(F.try_variant_get("doc.tree", "$", "map<string,variant>"))
    single = (F.size(root) == 1) & F.try_variant_get(F.get(root, F.lit(0)), "$", "array<variant>").isNull()
    bad = F.col(f"doc.{CORRUPT}").isNotNull() | (F.col(col).isNotNull() & ~F.coalesce(single, F.lit(False)))
    tags = F.length(col) - F.length(F.replace(F.col(col), F.lit("</"), F.lit("<")))  # closing tags: no less than the depth
    # a food's children as text: plain ones marked, the others as JSON; parsed
    # before the explode, as every field would parse its food again after it
    parts = ",".join(f"`{t}` string" for t in _PARTS)
    found = F.transform(descendants(F.col("doc.tree"), "food", tags + 1), lambda v: F.from_json(F.to_json(v), parts))
    nothing = F.array(F.lit(None).cast("struct<" + parts.replace("` ", "`:") + ">"))
    rows = docs.select(bad.alias("_bad"), F.col(col).alias("_text"), F.explode(F.when(bad, nothing).otherwise(found)).alias("f"))
    zero = F.when(~F.col("_bad"), F.lit("0"))

    def _element(*path: str) -> Column:
        s = F.col("f").getField(path[0])
        return _first_text(s if len(path) == 1 else _first_of(s, path[1]))

    def _calories(name: str) -> Column:
        return F.nullif(_first_of(F.col("f").getField("calories"), f"_{name}"), F.lit("")).cast("int")

    flat = rows.select(
        _element("name").alias("food_name"),
        _element("mfr").alias("manufacturer"),
        _element("serving").alias("serving_size"),
        _calories("total").alias("calories_total"),
        _calories("fat").alias("calories_fat"),
        _element("total-fat").alias("total_fat"),
        _element("saturated-fat").alias("saturated_fat"),
        _element("cholesterol").alias("cholesterol"),
        _element("sodium").alias("sodium"),
        _element("carb").alias("carb"),
        _element("fiber").alias("fiber"),
        _element("protein").alias("protein"),
        F.coalesce(_element("vitamins", "a"), zero).alias("vitamin_a"),
        F.coalesce(_element("vitamins", "c"), zero).alias("vitamin_c"),
        F.coalesce(_element("minerals", "ca"), zero).alias("calcium"),
        F.coalesce(_element("minerals", "fe"), zero).alias("iron"),
        "_bad",
        "_text",
    )
    return rejects.mark(flat, F.when(F.col("_bad"), rejects.MALFORMED), F.col("_text")).drop("_bad", "_text")


def flat_foods(raw_xml: DataFrame, col: str = "xml_data") -> DataFrame:
    """The foods of ``marked_foods``; a malformed document fails the run."""
    return _strict(marked_foods(raw_xml, col), "foods")


# ---- loads (SNK-1) -----------------------------------------------------------


def _load(marked: DataFrame, contract, table: str, rejects_path: str, load_id: str) -> dict[str, int]:
    part = rejects.split(marked, contract.table)
    rejects.store(part, rejects_path, load_id)
    append_held(conform(part.rows, contract), table, contract)
    return {"loaded": part.loaded, "rejected": part.rejected}


def load_pets(raw_json: DataFrame, table: str, rejects_path: str, load_id: str, col: str = "json_data") -> dict[str, int]:
    """Append the pets of a table of JSON documents to ``table`` (a rerun
    appends them again) and put malformed documents below ``rejects_path``
    (a rerun of ``load_id`` replaces them). Documents are parsed once. Returns
    the rows loaded and the documents rejected."""
    return _load(marked_pets(raw_json, col), schemas.FLAT_PETS, table, rejects_path, load_id)


def load_foods(raw_xml: DataFrame, table: str, rejects_path: str, load_id: str, col: str = "xml_data") -> dict[str, int]:
    """Append the foods of a table of XML documents; see ``load_pets``."""
    return _load(marked_foods(raw_xml, col), schemas.FLAT_FOODS, table, rejects_path, load_id)


