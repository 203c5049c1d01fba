"""Text lines parsed against a declared layout, with the lines that do not fit kept apart.

A parser adds the layout's columns and ``_corrupt_record``: null where the line fits, else the line itself. Other
columns of the input (a file path, a key) pass through, so a rejected line can be traced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def parse_csv(lines: DataFrame, names: Sequence[str], line: str = "value", corrupt: Column | None = None) -> DataFrame:
    """CSV lines as string columns ``names`` (in the order of the file); too few or too many fields do not fit.

    ``corrupt`` is a further condition on the parsed columns under which a line is rejected.
    """
    schema = ", ".join(f"`{n}` STRING" for n in [*names, CORRUPT])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rest = [c for c in lines.columns if c != line]
    parsed = lines.withColumn("_row", F.from_csv(F.col(line), schema, options))
    flat = parsed.select(*rest, line, "_row.*")
    if corrupt is not None:
        flat = flat.withColumn(CORRUPT, F.coalesce(CORRUPT, F.when(corrupt, F.col(line))))
    return flat.drop(line)


def parse_fields(lines: DataFrame, layout: T.StructType, line: str = "value") -> DataFrame:
    """Fields separated by runs of white space; a field that is missing or of another type is null, and the line does not fit.

    Blank lines are skipped.
    """
    rest = [c for c in lines.columns if c != line]
    parts = F.split(F.trim(F.col(line)), r"\s+")
    cells = {f.name: F.try_element_at(parts, F.lit(i + 1)).try_cast(f.dataType) for i, f in enumerate(layout.fields)}
    fits = F.size(parts) == F.lit(len(layout.fields))
    for c in cells.values():
        fits = fits & c.isNotNull()
    return lines.where(F.trim(F.col(line)) != F.lit("")).select(
        *rest, *[c.alias(n) for n, c in cells.items()], F.when(~fits, F.col(line)).alias(CORRUPT))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The lines that do not fit, whole, with the pass-through columns ``keep``."""
    return parsed.where(F.col(CORRUPT).isNotNull()).select(*keep, F.col(CORRUPT).alias("line"))
