"""File sources: CSV exports, JSON-lines document collections, Parquet tables
(SRC-1, SRC-2, SRC-5), and documents held in table columns (SRC-3, SRC-4).

Every file source attaches ``_src``, a struct (file, block offset, row id)
whose order is the file order of the rows: Spark has no source order of its
own, and the reference's "keep first/last" de-duplication depends on it.
``_src.row`` is unique per row and stable for a given set of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SRC = "_src"
CORRUPT = "_corrupt_record"


def source_order(file_path: Column, block_start: Column, row: Column) -> Column:
    return F.struct(file_path.alias("file"), block_start.cast("bigint").alias("block"), row.cast("bigint").alias("row"))


def with_file_order(df: DataFrame) -> DataFrame:
    """Attach ``_src`` from the hidden file metadata of a file scan."""
    return df.withColumn(
        SRC,
        source_order(
            F.col("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id(),
        ),
    )


def read_iot_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column as text, columns addressed by name (SRC-1).

    No positional schema: an extra or reordered column in the export must
    not shift values, so types are applied later by name.
    """
    raw = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return with_file_order(raw)


def read_collection(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A document collection exported as JSON lines (SRC-2).

    The explicit schema drops ``_id`` and any unknown field; a field of the
    wrong shape reads as NULL without losing the rest of the document. The
    text of a line that does not parse is kept in ``_corrupt_record``
    (``split_rejects`` takes such lines out). An empty folder gives an empty
    frame, so the load is a no-op.
    """
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return with_file_order(reader.json(path))


def split_rejects(docs: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``(documents with a key, rejects)``: a document without a key is never
    loaded. Rejects are ``(reason, file, record)``: ``malformed`` lines with
    their text, and documents with ``no key``, as JSON."""
    present = set(docs.columns)
    corrupt = F.col(CORRUPT) if CORRUPT in present else F.lit(None).cast("string")
    source = F.col(f"{SRC}.file") if SRC in present else F.lit(None).cast("string")
    body = F.to_json(F.struct(*[c for c in docs.columns if c not in (CORRUPT, SRC)]))
    bad = docs.where(F.col(key).isNull()).select(
        F.when(corrupt.isNotNull(), F.lit("malformed")).otherwise(F.lit("no key")).alias("reason"),
        source.alias("file"),
        F.coalesce(corrupt, body).alias("record"),
    )
    return docs.where(F.col(key).isNotNull()).drop(CORRUPT), bad


def malformed(df: DataFrame, col: str, doc: str = "doc") -> DataFrame:
    """Rows whose text in ``col`` is there but did not parse into ``doc``; to
    be counted or stored next to a load of the parsed documents (SRC-3, SRC-4)."""
    return df.where(F.col(col).isNotNull() & (F.col(doc).isNull() | F.col(f"{doc}.{CORRUPT}").isNotNull()))


def _once(df: DataFrame, value: Column, alias: str) -> DataFrame:
    """``df`` with ``value`` computed once a row: as a plain column, the
    optimizer would compute it anew for every field that is read of it."""
    return df.select(*[c for c in df.columns if c != alias], F.explode(F.array(value)).alias(alias))


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return schema if CORRUPT in schema.names else T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def parse_json_column(df: DataFrame, col: str, schema: T.StructType, alias: str = "doc") -> DataFrame:
    """Documents held as JSON text in a column, parsed in place (SRC-3); text
    that does not parse is kept in ``<alias>._corrupt_record``."""
    return _once(df, F.from_json(F.col(col), _with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT}), alias)


#: Fixed value: stands before every text of an XML document while it is parsed
#: (a private-use character, which no exchanged text should hold).
_TEXT = "\uE000"


def is_text(c: Column) -> Column:
    """Whether a value of ``parse_xml_tree`` is a text (and not the JSON of an element)."""
    return F.ltrim(c).startswith(_TEXT)


def plain_text(c: Column) -> Column:
    """A text of ``parse_xml_tree`` as it stands in the document."""
    return F.replace(c, F.lit(_TEXT), F.lit(""))


def parse_xml_tree(df: DataFrame, col: str, alias: str = "doc") -> DataFrame:
    """Documents held as XML text in a column, parsed whole and in place
    (SRC-4): ``<alias>.tree`` is the document as VARIANT (an object whose one
    entry is the root element), ``<alias>._corrupt_record`` is set where it
    does not parse.

    Elements are objects, repeated ones arrays; attributes are ``_name``
    entries, the text of an element with attributes is ``_VALUE``. White space
    around texts is kept, as an XPath ``text()`` read keeps it. Texts come back
    through ``plain_text``: each is marked before parsing, as the parser would
    otherwise turn ``007`` or ``3.50`` into numbers.
    """
    body = F.regexp_replace(F.col(col), r"^\uFEFF?\s*<\?xml[^>]*\?>", "")
    body = F.regexp_replace(body, r"^\s*<!DOCTYPE[^>\[]*(\[[^\]]*\])?[^>]*>", "")
    body = F.regexp_replace(body, "<!--(?s:.*?)-->", "")
    body = F.regexp_replace(body, r"<!\[CDATA\[", "<![CDATA[" + _TEXT)
    body = F.regexp_replace(body, r">([^<]*[^<\s][^<]*)<", ">" + _TEXT + "$1<")
    options = {"ignoreSurroundingSpaces": "false", "attributePrefix": "_", "valueTag": "_VALUE", "columnNameOfCorruptRecord": CORRUPT}
    whole = F.concat(F.lit("<document><tree>"), body, F.lit("</tree></document>"))
    return _once(df, F.from_xml(whole, f"tree variant, {CORRUPT} string", options), alias)


def parse_xml_column(df: DataFrame, col: str, schema: T.StructType, alias: str = "doc") -> DataFrame:
    """Documents held as XML text in a column, parsed in place (SRC-4).

    Surrounding whitespace of text nodes is kept, as an XPath ``text()``
    read keeps it; attributes appear as ``_name`` fields, element text next
    to attributes as ``_VALUE``.
    """
    options = {"ignoreSurroundingSpaces": "false", "attributePrefix": "_", "valueTag": "_VALUE"}
    return df.withColumn(alias, F.from_xml(F.col(col), schema, options))
