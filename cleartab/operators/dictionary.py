"""Survey dictionaries: from a sheet-like table to names and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleartab.functions import text
from cleartab.operators.columns import ensure_columns
from cleartab.operators.ordered import forward_fill

# Column titles of the dictionary and the mark for "no category".
VAR_CODE = "Código da variável"
VAR_TEXT = "Descrição da variável"
RULE = "Regra"
CAT_CODE = "Código da categoria"
CAT_TEXT = "Descrição da categoria"
NO_CATEGORY = "-"


def _filled(col: Column) -> Column:
    return F.coalesce(text.strip(col) != "", F.lit(False))


def read_dictionary(sheet: DataFrame, row: str = "row_no") -> tuple[DataFrame, DataFrame]:
    """``(variables(var_code, var_name, row_no), categories(var_code, cat_code, label))``.

    The variable code stands only on its first row, so it is filled forward;
    a code alone on a row is a section title or a note and ends the variable.
    Repeated definitions: the last one wins.
    """
    sheet = ensure_columns(sheet, [VAR_CODE, VAR_TEXT, RULE, CAT_CODE, CAT_TEXT])
    code = text.strip(F.col(VAR_CODE))
    has_code = _filled(F.col(VAR_CODE))
    title = has_code & ~_filled(F.col(VAR_TEXT)) & ~_filled(F.col(CAT_CODE))
    filled = forward_fill(sheet.withColumn("__all", F.lit(0)), ["__all"], row,
                          F.when(has_code & ~title, code), title, "var_code")
    filled = filled.filter(F.col("var_code").isNotNull())
    # A variable without a description keeps its code as name.
    name = F.when(_filled(F.col(VAR_TEXT)), text.slug(text.drop_cross_reference(F.col(VAR_TEXT))))
    variables = (
        filled.filter(has_code)
        .groupBy("var_code")
        .agg(F.max(F.struct(F.col(row), name.alias("name"))).alias("d"))
        .select("var_code", F.col("d.name").alias("var_name"), F.col(f"d.{row}").alias(row)))
    category = text.strip(F.col(CAT_CODE))
    categories = (
        filled.filter(_filled(F.col(CAT_CODE)) & (category != NO_CATEGORY))
        .groupBy("var_code", category.alias("cat_code"))
        .agg(F.max(F.struct(F.col(row), text.clean_text(F.col(CAT_TEXT)).alias("label")))
             .alias("d"))
        .select("var_code", "cat_code", F.col("d.label").alias("label")))
    return variables, categories


def output_names(columns: Sequence[str], names: Mapping[str, str]) -> list[str]:
    """Final column names in order: the dictionary's name, or the code when it has
    none; a repeated name gets the code's slug as suffix.

    Spark resolves names without case, so a clash that remains is refused.
    """
    out, seen = [], set()
    for column in columns:
        name = names.get(column) or column
        if name in seen:
            name = f"{name}_{text.slug_name(column)}"
        else:
            seen.add(name)
        out.append(name)
    folded = [n.lower() for n in out]
    clashes = sorted({n for n, f in zip(out, folded) if folded.count(f) > 1})
    if clashes:
        raise ValueError(f"column names differ only by case or repeat: {clashes}")
    return out


def apply_dictionary(df: DataFrame, names: Mapping[str, str], categories: DataFrame) -> DataFrame:
    """Recode every listed column (unknown codes stay) and rename all columns.

    ``categories(var_code, cat_code, label)`` stays a table: it is folded into one
    value, a map of maps, that all recodes of the projection share. Its size is
    that of the questionnaire, not of the data.
    """
    books = (categories.groupBy("var_code")
             .agg(F.map_from_entries(F.collect_list(F.struct("cat_code", "label"))).alias("book"))
             .agg(F.map_from_entries(F.collect_list(F.struct("var_code", "book"))).alias("books")))
    book = books.scalar()

    def recoded(column: str) -> Column:
        value = F.col(f"`{column}`")
        label = F.try_element_at(F.try_element_at(book, F.lit(column)), text.normal_code(value))
        return F.coalesce(label, value).alias(column)

    out = df.select(*[recoded(c) if c in names else F.col(f"`{c}`") for c in df.columns])
    return out.toDF(*output_names(df.columns, names))


def collect_names(variables: DataFrame) -> dict[str, str]:
    """Names by variable code. They become the schema, so the driver needs them."""
    return {r.var_code: r.var_name for r in variables.select("var_code", "var_name").collect()}
