"""Clicks on interface elements."""

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions import hash16
from footfall.operators.bodies import ENVELOPE, parse_click


def element_id(url="url", path="ePath", prefix: str = "") -> Column:
    """Id of an element from its page and path. Give the client's own prefix to
    get the ids the client writes. A missing path counts as the text `(null)`."""
    url = F.col(url) if isinstance(url, str) else url
    path = F.col(path) if isinstance(path, str) else path
    return hash16(F.lit(prefix), url, F.coalesce(path, F.lit("(null)")))


def normalise_element_path(clicks: DataFrame, path: str = "ePath") -> DataFrame:
    """Cut the first table wrapper out of the path, and list its nodes from the
    root as (cls, idx); idx is NULL when the class has no siblings there."""
    clean = F.regexp_replace(path, r"\A(.*?)UITableViewWrapperView/", "$1")

    def node(text):
        idx = F.regexp_extract(text, r"\[(\d+)\]$", 1)
        return F.struct(
            F.regexp_replace(text, r"\[\d+\]$", "").alias("cls"),
            F.when(idx != "", idx.cast("int")).alias("idx"),
        )

    return clicks.withColumn(path, clean).withColumn(
        "nodes", F.transform(F.split(path, "/"), node)
    )


def split_element_position(clicks: DataFrame, position: str = "ePosition") -> DataFrame:
    """`section:row` of tables and collections; a plain index has no section."""
    parts = F.split(position, ":")
    paired = F.size(parts) == 2
    return clicks.withColumns(
        {
            "section": F.when(paired, F.get(parts, F.lit(0)).try_cast("int")),
            "row": F.element_at(parts, -1).try_cast("int"),
        }
    )


def element_text(children: DataFrame, element=("element_id",)) -> DataFrame:
    """Text of a container: the visible, non-empty texts of its children in
    order, joined with "-". Input: element, child_no, kind, text, number, hidden.
    Switches read checked/unchecked, steppers and sliders their value."""
    kind, number = F.col("kind"), F.col("number")
    # six significant digits without trailing zeros, as %g writes them
    exact = F.format_string("%.5e", number)
    power = F.regexp_extract(exact, r"e([+-]\d+)$", 1).try_cast("int")
    bare = lambda c: F.regexp_replace(c, r"\.?0+$", "")
    scientific = F.concat(bare(F.regexp_extract(exact, r"^([^e]*)e", 1)), F.regexp_extract(exact, r"(e.*)$", 1))
    plain = bare(F.format_string("%.10f", exact.cast("double")))
    short = F.when((power < -4) | (power >= 6), scientific).otherwise(plain)
    text = (
        F.when(kind == "switch", F.when(number != 0, "checked").otherwise("unchecked"))
        .when(kind == "stepper", short)
        .when(kind == "slider", F.format_string("%.6f", number))
        .otherwise(F.col("text"))
    )
    shown = children.withColumn("__text", text).where(
        ~F.coalesce("hidden", F.lit(False)) & (F.length("__text") > 0)
    )
    # the joined text is one value of the output row, so the list per element is
    # no larger than the result itself
    listed = F.array_sort(F.collect_list(F.struct("child_no", "__text")))
    return shown.groupBy(*element).agg(
        F.array_join(F.transform(listed, lambda c: c["__text"]), "-").alias("eContent")
    )


def override_properties(clicks: DataFrame, overrides: DataFrame) -> DataFrame:
    """Per-element properties replace those of the click where they are set.
    `overrides`: id plus any of eType, ePath, ePosition, eContent, title."""
    names = [c for c in ("eType", "ePath", "ePosition", "eContent", "title") if c in overrides.columns]
    given = overrides.select("id", *[F.col(c).alias("__" + c) for c in names])
    return (
        clicks.join(given, "id", "left")
        .withColumns({c: F.coalesce("__" + c, c) for c in names})
        .drop(*["__" + c for c in names])
    )


def click_table(events: DataFrame, prefix: str = "") -> DataFrame:
    """Clicks with an id for every element, path nodes and position parts."""
    clicks = parse_click(events, keep=ENVELOPE)
    clicks = clicks.withColumn("id", F.coalesce("id", element_id(prefix=prefix)))
    return split_element_position(normalise_element_path(clicks))
