"""Native to logical types, per kind of source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..literals import literal_table

# Native type -> logical type.
CDM = {
    "string": "VARCHAR", "char": "VARCHAR", "guid": "VARCHAR", "entityId": "VARCHAR", "entityName": "VARCHAR",
    "integer": "INTEGER", "smallInteger": "INTEGER", "bigInteger": "BIGINT", "boolean": "BOOLEAN", "decimal": "DECIMAL",
    "double": "DOUBLE", "float": "FLOAT", "money": "DECIMAL", "currency": "DECIMAL", "date": "DATE", "time": "TIME",
    "dateTime": "DATETIME", "dateTimeOffset": "DATETIME",
}
ODOO = {
    "Char": "VARCHAR", "Text": "TEXT", "Html": "TEXT", "Integer": "INTEGER", "Float": "DECIMAL", "Monetary": "DECIMAL",
    "Boolean": "BOOLEAN", "Date": "DATE", "Datetime": "DATETIME", "Selection": "VARCHAR", "Many2one": "INTEGER",
    "One2many": "RELATION", "Many2many": "RELATION", "Binary": "BLOB", "Reference": "VARCHAR", "Json": "TEXT",
}
TRYTON = {
    "Char": "VARCHAR", "Text": "TEXT", "FullText": "TEXT", "MultiSelection": "VARCHAR", "Integer": "INTEGER",
    "BigInteger": "BIGINT", "Float": "DECIMAL", "Numeric": "DECIMAL", "Boolean": "BOOLEAN", "Date": "DATE",
    "DateTime": "DATETIME", "Timestamp": "DATETIME", "Time": "TIME", "TimeDelta": "INTEGER", "Selection": "VARCHAR",
    "Many2One": "INTEGER", "One2Many": "RELATION", "Many2Many": "RELATION", "One2One": "RELATION", "Reference": "VARCHAR",
    "Binary": "BLOB", "Dict": "TEXT",
}
DOCTYPE = {
    "Data": "VARCHAR", "Small Text": "TEXT", "Text": "TEXT", "Long Text": "TEXT", "Text Editor": "TEXT", "Code": "TEXT",
    "Markdown Editor": "TEXT", "HTML Editor": "TEXT", "Int": "INTEGER", "Float": "DECIMAL", "Percent": "DECIMAL",
    "Currency": "DECIMAL", "Check": "BOOLEAN", "Date": "DATE", "Datetime": "DATETIME", "Time": "TIME",
    "Duration": "INTEGER", "Select": "VARCHAR", "Link": "VARCHAR", "Dynamic Link": "VARCHAR", "Table": "RELATION",
    "Table MultiSelect": "RELATION", "Attach": "VARCHAR", "Attach Image": "VARCHAR", "Phone": "VARCHAR",
    "Read Only": "VARCHAR", "Rating": "DECIMAL", "Color": "VARCHAR", "Password": "VARCHAR", "Signature": "TEXT",
    "Geolocation": "TEXT",
}
FHIR = {
    "string": "VARCHAR", "code": "VARCHAR", "id": "VARCHAR", "markdown": "TEXT", "uri": "VARCHAR", "url": "VARCHAR",
    "canonical": "VARCHAR", "oid": "VARCHAR", "uuid": "VARCHAR", "base64binary": "BLOB", "boolean": "BOOLEAN",
    "integer": "INTEGER", "positiveint": "INTEGER", "unsignedint": "INTEGER", "decimal": "DECIMAL", "date": "DATE",
    "datetime": "DATETIME", "instant": "DATETIME", "time": "TIME",
}
OPENAPI_FORMATS = {"date": "DATE", "date-time": "DATETIME", "byte": "BLOB", "binary": "BLOB", "uuid": "VARCHAR"}
OPENAPI = {
    "string": "VARCHAR", "integer": "INTEGER", "number": "DECIMAL", "boolean": "BOOLEAN", "array": "RELATION",
    "object": "OBJECT",
}
# In order of preference.
VOCABULARY = {
    "schema:Boolean": "BOOLEAN", "schema:Integer": "INTEGER", "schema:Float": "DECIMAL", "schema:Number": "DECIMAL",
    "schema:DateTime": "DATETIME", "schema:Date": "DATE", "schema:Time": "TIME", "schema:URL": "VARCHAR",
    "schema:Text": "VARCHAR",
}
B2MML = {
    "IdentifierType": "VARCHAR", "DescriptionType": "VARCHAR", "DateTimeType": "DATETIME", "ValueType": "OBJECT",
    "QuantityValueType": "OBJECT",
}

TYPE_MAPS = {
    "cdm": CDM, "odoo": ODOO, "tryton": TRYTON, "doctype": DOCTYPE, "fhir": FHIR, "openapi": OPENAPI,
    "vocabulary": VOCABULARY, "b2mml": B2MML,
}
# Types outside the map; a source without a default drops such fields.
DEFAULTS = {"cdm": "VARCHAR", "fhir": "VARCHAR", "openapi": "VARCHAR", "vocabulary": "RELATION", "b2mml": "OBJECT"}


def map_column(native: Column, types: dict[str, str], default: str | None = None) -> Column:
    """One map as a literal lookup: stays in generated code, no join."""
    pairs = [F.lit(x) for kv in types.items() for x in kv]
    found = F.element_at(F.create_map(*pairs), native)
    return found if default is None else F.coalesce(found, F.lit(default))


def type_table(spark: SparkSession) -> DataFrame:
    rows = [(kind, native, logical) for kind, types in TYPE_MAPS.items() for native, logical in types.items()]
    return literal_table(spark, ["kind", "native_type", "logical_type"], rows)


def map_types(items: DataFrame) -> DataFrame:
    """Add ``data_type`` to rows with ``kind`` and ``native_type``."""
    spark = items.sparkSession
    defaults = literal_table(spark, ["kind", "default_type"], DEFAULTS.items())
    return (items.join(type_table(spark), ["kind", "native_type"], "left").join(defaults, "kind", "left")
            .withColumn("data_type", F.coalesce("logical_type", "default_type")).drop("logical_type", "default_type"))
