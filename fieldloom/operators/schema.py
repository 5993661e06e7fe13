"""Table definitions out of the catalog: columns, keys, order of creation, text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import after_first_dot, entity_of, identifier
from ..functions.rules import dialect_type, enum_check, is_collection, plain_type, relation_target
from ..storage import materialize
from .graph import dependency_levels
from .ranking import with_global_rank

# Primary key column by dialect.
PRIMARY_KEYS = {
    "sqlite": "INTEGER PRIMARY KEY", "postgres": "SERIAL PRIMARY KEY", "mysql": "INT AUTO_INCREMENT PRIMARY KEY",
}
# What a script starts with, by dialect; the default dialect needs nothing.
PREAMBLES = {"sqlite": "PRAGMA foreign_keys = ON;", "mysql": "SET FOREIGN_KEY_CHECKS = 1;"}
# Sections of a table's text, in order.
HEADER, REVERSE, OPEN, KEY, COLUMN, FOREIGN, CLOSE = range(7)

COLUMNS = ["data_type", "byte_length", "decimal_scale", "is_required", "allowed_values", "description"]


def one_per_name(items: DataFrame) -> DataFrame:
    """The selection of an export holds each name once; the first category brings it."""
    rest = [c for c in items.columns if c != "name"]
    return items.groupBy("name").agg(F.min_by(F.struct(*rest), "category").alias("r")).select("name", "r.*")


def _candidates(items: DataFrame) -> DataFrame:
    table, column = identifier(entity_of(F.col("name"))), identifier(after_first_dot(F.col("name")))
    return (items.select(table.alias("table_name"), column.alias("column_name"), "name", *COLUMNS,
                         F.struct((~F.col("is_required")).alias("optional"), "name").alias("place"))
            .filter((F.col("column_name") != "") & (F.col("column_name") != F.concat("table_name", F.lit("_id")))))


def _first_columns(items: DataFrame) -> DataFrame:
    """One definition per column, required items first, then by name."""
    rows = _candidates(items).filter(~is_collection(F.col("description")))
    return rows.groupBy("table_name", "column_name").agg(
        F.min("place").alias("place"), F.min_by(F.struct("name", *COLUMNS), "place").alias("r")).select(
        "table_name", "column_name", "place", "r.*")


def table_names(items: DataFrame) -> DataFrame:
    return items.select(identifier(entity_of(F.col("name"))).alias("table_name")).distinct()


def _numbered(rows: DataFrame) -> DataFrame:
    """Position inside the table, from one global order instead of a window per table."""
    ranked = with_global_rank(rows.withColumn("optional", F.col("place.optional")).drop("place"),
                              ["table_name", "optional", "name", "column_name"], "rank")
    first = ranked.groupBy("table_name").agg(F.min("rank").alias("first"))
    return ranked.join(first, "table_name").withColumn(
        "position", F.col("rank") - F.col("first") + 1).drop("rank", "first", "optional")


def table_columns(items: DataFrame) -> DataFrame:
    """Ordered column definitions with resolved foreign keys."""
    target = relation_target(F.col("description"))
    columns = _numbered(_first_columns(items)).withColumn("target", target)
    known = table_names(items).select(F.col("table_name").alias("target"), F.lit(True).alias("known"))
    return columns.join(known, "target", "left").withColumn(
        "is_fk", F.coalesce("known", F.lit(False))).drop("known")


def foreign_keys(items: DataFrame) -> DataFrame:
    """``(child, column_name, parent)``, self references included."""
    target = relation_target(F.col("description"))
    refs = _first_columns(items).select("table_name", "column_name", target.alias("target")).filter("target IS NOT NULL")
    inside = refs.join(table_names(items).withColumnRenamed("table_name", "target"), "target", "left_semi")
    return inside.select(F.col("table_name").alias("child"), "column_name", F.col("target").alias("parent"))


def external_references(items: DataFrame) -> DataFrame:
    """References whose table is not part of the selection."""
    target = relation_target(F.col("description"))
    refs = _first_columns(items).select("table_name", "column_name", target.alias("target")).filter("target IS NOT NULL")
    return refs.join(table_names(items).withColumnRenamed("table_name", "target"), "target", "left_anti").select(
        "table_name", "column_name", "target")


def table_edges(items: DataFrame) -> DataFrame:
    """Distinct table dependencies with the kind of the reference."""
    target = relation_target(F.col("description"))
    refs = _first_columns(items).select(F.col("table_name").alias("child"), target.alias("parent")).filter(
        "parent IS NOT NULL").groupBy("child", "parent").agg(F.count("*").alias("columns"))
    known = table_names(items).select(F.col("table_name").alias("parent"), F.lit(True).alias("known"))
    kind = F.when(F.col("known").isNull(), "external").when(F.col("child") == F.col("parent"), "self").otherwise("foreign_key")
    return refs.join(known, "parent", "left").select("child", "parent", "columns", kind.alias("kind"))


def reverse_relations(items: DataFrame) -> DataFrame:
    """Collections are no columns of the table; one that comes after a column of
    the same name is hidden by it."""
    rows = _candidates(items).filter(is_collection(F.col("description")))
    taken = _first_columns(items).select("table_name", "column_name", F.col("place").alias("taken_at"))
    rows = rows.join(taken, ["table_name", "column_name"], "left")
    return rows.filter(F.col("taken_at").isNull() | (F.col("place") < F.col("taken_at"))).select(
        "table_name", "column_name", "name", "description", "place")


def creation_levels(items: DataFrame) -> DataFrame:
    edges = foreign_keys(items).select("child", "parent").distinct()
    return dependency_levels(table_names(items), edges)


def _lines(rows: DataFrame, lines: list[tuple[str, int, Column, Column]]) -> DataFrame:
    """Several text lines per row; lines without text are dropped."""
    return rows.select("table_name", F.inline(F.array(*[
        F.struct(F.lit(d).alias("dialect"), F.lit(section).alias("section"), position.cast("bigint").alias("position"), line.alias("line"))
        for d, section, position, line in lines]))).filter(F.col("line").isNotNull())


def create_table_lines(items: DataFrame, columns: DataFrame, levels: DataFrame, dialects: tuple[str, ...]) -> DataFrame:
    """The scripts as rows: sort by level, table, section and position to read one.

    ``columns`` are the written ``table_columns`` of ``items``.  A table's text is
    never gathered in one task; commas only need the last position of a table,
    which is an aggregate.  All dialects come from the same scans.
    """
    per_table = columns.groupBy("table_name").agg(
        F.count("*").alias("n_columns"), F.count_if("is_fk").alias("n_keys"), F.max("position").alias("last_column"),
        F.max(F.when(F.col("is_fk"), F.col("position"))).alias("last_key"))
    about = items.select(identifier(entity_of(F.col("name"))).alias("table_name"), "name", "source_standard").groupBy(
        "table_name").agg(F.min_by("source_standard", "name").alias("source"), entity_of(F.max("name")).alias("entity"))
    tables = about.join(per_table, "table_name", "left").fillna(0, ["n_columns", "n_keys"])
    tables = materialize(tables, "tables")
    zero, name, at = F.lit(0), F.col("table_name"), F.col("position")

    header = F.concat(F.lit("-- "), "entity", F.lit("  ("), F.col("n_columns").cast("string"), F.lit(" columns, "),
                      F.col("n_keys").cast("string"), F.lit(" FKs)  [source: "), F.coalesce("source", F.lit("None")), F.lit("]"))
    key_comma = F.when(F.col("n_columns") > 0, ",").otherwise("")
    frames = _lines(tables, [line for d in dialects for line in (
        (d, HEADER, zero, header),
        (d, OPEN, zero, F.concat(F.lit("CREATE TABLE "), name, F.lit(" ("))),
        (d, KEY, zero, F.concat(F.lit("    "), name, F.lit("_id " + PRIMARY_KEYS[d]), key_comma)),
        (d, CLOSE, zero, F.lit(");")))])

    text = F.concat(F.lit("--   reverse relation: "), "column_name", F.lit("  "), "description")
    reverse = _lines(_numbered(reverse_relations(items)), [(d, REVERSE, at, text) for d in dialects])

    ends = columns.join(tables.select("table_name", "n_keys", "last_column", "last_key"), "table_name")
    is_fk, check = F.col("is_fk"), enum_check(F.col("column_name"), F.col("allowed_values"))
    comma = F.when((F.col("n_keys") > 0) | (at < F.col("last_column")), ",").otherwise("")
    comment = F.when(F.col("target").isNotNull() & ~is_fk, F.concat(
        F.lit("  -- external ref: "), F.substring("description", 1, 50))).otherwise("")
    foreign = F.when(is_fk, F.concat(
        F.lit("    FOREIGN KEY ("), "column_name", F.lit(") REFERENCES "), "target", F.lit("("), "target", F.lit("_id)"),
        F.when(at < F.col("last_key"), ",").otherwise("")))

    def definition(dialect: str) -> Column:
        kind = dialect_type(dialect, F.col("data_type"), F.col("byte_length"), F.col("decimal_scale"), is_fk)
        return F.concat(
            F.lit("    "), "column_name", F.lit(" "), kind, F.when(F.col("is_required"), " NOT NULL").otherwise(""),
            F.when(~is_fk & check.isNotNull(), F.concat(F.lit(" "), check)).otherwise(""), comma, comment)

    body = _lines(ends, [line for d in dialects for line in ((d, COLUMN, at, definition(d)), (d, FOREIGN, at, foreign))])
    lines = frames.unionByName(reverse).unionByName(body)
    return lines.join(levels, "table_name").select("dialect", "level", "table_name", "section", "position", "line")


def selected_items(items: DataFrame, hits: DataFrame) -> DataFrame:
    """The items that terms resolve to, each name once: the first term, then the first category brings it.

    ``hits`` are the rows (term_pos, category, name) of a search over ``items``.
    """
    first = hits.groupBy("name").agg(F.min_by("category", F.struct("term_pos", "category")).alias("category"))
    return items.join(first, ["category", "name"], "left_semi")


def script_lines(items: DataFrame, terms: DataFrame, dialects: tuple[str, ...]) -> DataFrame:
    """Scripts of a selection, one per dialect, as rows: a head, and the tables in order of creation.

    What a column refers to is a foreign key if its table is part of the selection, and else
    only named. The head lists the terms (term_pos, term), the numbers of tables and items, and
    what the dialect needs first; it sorts before all tables. Without items there are no lines.
    """
    columns = materialize(table_columns(items), "columns")
    lines = create_table_lines(items, columns, creation_levels(items), dialects)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("term_pos", "term"))), lambda t: t["term"]), ", ")
    none, zero = F.lit(None).cast("string").alias("terms"), F.lit(0).cast("bigint")
    facts = (items.agg(F.count("*").alias("items"), zero.alias("tables"), none)
             .unionByName(table_names(items).agg(zero.alias("items"), F.count("*").alias("tables"), none))
             .unionByName(terms.agg(zero.alias("items"), zero.alias("tables"), joined.alias("terms"))))
    counts = facts.agg(*[F.max(c).alias(c) for c in ("items", "tables", "terms")]).filter("items > 0")
    size = F.concat(F.lit("-- "), F.col("tables").cast("string"), F.lit(" tables, "), F.col("items").cast("string"), F.lit(" items"))
    head = [(d, n, line) for d in dialects for n, line in enumerate((F.lit(f"-- dialect: {d}"), F.concat(F.lit("-- terms: "), "terms"), size, F.lit(PREAMBLES.get(d))))]
    rows = counts.select(F.inline(F.array(*[
        F.struct(F.lit(d).alias("dialect"), F.lit(n).cast("bigint").alias("position"), line.alias("line")) for d, n, line in head]))).filter("line IS NOT NULL")
    return rows.select("dialect", F.lit(-1).alias("level"), F.lit("").alias("table_name"), F.lit(HEADER).alias("section"), "position", "line").unionByName(lines)


def plain_table_lines(items: DataFrame) -> DataFrame:
    """The simple form: every field a column, one dialect, no foreign keys."""
    entity = entity_of(F.col("name"))

    def plain(c: Column) -> Column:
        return F.regexp_replace(F.lower(c), "[^0-9a-z_]", "_")

    rows = items.select(entity.alias("table_name"), plain(after_first_dot(F.col("name"))).alias("column_name"), "name", *COLUMNS,
                        F.struct((~F.col("is_required")).alias("optional"), "name").alias("place"))
    rows = _numbered(rows)
    last = rows.groupBy("table_name").agg(F.count("*").alias("n"))
    table = plain(F.col("table_name"))
    check = enum_check(F.col("column_name"), F.col("allowed_values"))
    line = F.concat(
        F.lit("    "), "column_name", F.lit(" "), plain_type(F.col("data_type"), F.col("byte_length"), F.col("decimal_scale")),
        F.when(F.col("is_required"), " NOT NULL").otherwise(""), F.when(check.isNotNull(), F.concat(F.lit(" "), check)).otherwise(""),
        F.when(F.col("position") < F.col("n"), ",").otherwise(""))
    frame = F.array(
        F.struct(F.lit(HEADER).alias("section"), F.concat(
            F.lit("-- "), "table_name", F.lit(" ("), F.col("n").cast("string"), F.lit(" fields)")).alias("line")),
        F.struct(F.lit(OPEN).alias("section"), F.concat(F.lit("CREATE TABLE "), table, F.lit(" (")).alias("line")),
        F.struct(F.lit(KEY).alias("section"), F.concat(F.lit("    "), table, F.lit("_id INTEGER PRIMARY KEY,")).alias("line")),
        F.struct(F.lit(CLOSE).alias("section"), F.lit(");").alias("line")))
    fixed = last.select("table_name", F.explode(frame).alias("f")).select(
        F.col("table_name").alias("entity"), "f.section", F.lit(0).cast("bigint").alias("position"), "f.line")
    body = rows.join(last, "table_name").select(
        F.col("table_name").alias("entity"), F.lit(COLUMN).alias("section"), "position", line.alias("line"))
    return fixed.unionByName(body)


def statements(lines: DataFrame, table: str = "table_name") -> DataFrame:
    """Text per table, for reading; a table's whole text becomes one value."""
    return lines.groupBy(table).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("section", "position", "line"))), lambda e: e["line"]), "\n").alias("text"))

