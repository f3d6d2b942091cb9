"""Fields of stored JSON documents, read as variants so that a field keeps its
JSON type: a number where a text belongs is not taken for a text."""

from pyspark.sql import functions as F

from meterspan.functions.scalars import to_number


def text_value(value):
    """A JSON text; null for any other type."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def number_value(value):
    """A JSON value as a number: texts are converted, null counts as 0, true as 1."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "VOID", F.lit(0.0))
        .when(kind == "STRING", to_number(F.try_variant_get(value, "$", "string")))
        .otherwise(F.try_variant_get(value, "$", "double"))
    )


def flag_value(value):
    """true or false; null for any other type."""
    return F.when(F.schema_of_variant(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))


def with_fields(df, document, texts=(), numbers=(), flags=()):
    """Adds the named fields of a variant column, null where absent or of the
    wrong type. A path uses dots; its last part names the column.

    Fields are cut out in one step and typed in the next, so the document is
    walked once per field however often the result is used."""
    paths = [*texts, *numbers, *flags]
    cut = df.withColumns(
        {f"_{p}": F.try_variant_get(document, f"$.{p}", "variant") for p in paths}
    )
    typed = {}
    for group, value in ((texts, text_value), (numbers, number_value), (flags, flag_value)):
        for p in group:
            typed[p.rpartition(".")[2]] = value(F.col(f"`_{p}`"))
    return cut.withColumns(typed).drop(*[f"_{p}" for p in paths])


def is_object(document):
    return F.schema_of_variant(document).startswith("OBJECT")


def items(text):
    """Elements of a JSON array text; null when it is anything else."""
    return F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
