"""Semi-structured helpers: VARIANT shredding and unknown-field capture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shred(df: DataFrame, variant: str, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """Typed columns for the hot paths of a VARIANT column; the column itself is kept.

    ``paths`` maps output column to (path, type). Written to parquet, the typed
    columns get statistics and pruning that a path read from a blob cannot have.
    """
    return df.withColumns({
        name: F.try_variant_get(F.col(variant), path, kind) for name, (path, kind) in paths.items()
    })


def read_shredded(stored: DataFrame, variant: str, shredded: dict[str, tuple[str, str]], wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """``stored`` with the columns ``wanted`` (name -> (path, type)) in place of the VARIANT.

    A path that was shredded with the same type is read from its typed column, so the scan
    opens that column alone; any other is taken from the VARIANT, and only then it is read.
    """
    typed = {found: name for name, found in shredded.items()}
    rest = [F.col(f"`{c}`") for c in stored.columns if c != variant and c not in shredded]
    picked = [
        (F.col(f"`{typed[path, kind]}`") if (path, kind) in typed else F.try_variant_get(F.col(variant), path, kind)).alias(name)
        for name, (path, kind) in wanted.items()]
    return stored.select(*rest, *picked)


def keep_unknown_fields(text: Column, known: list[str]) -> Column:
    """JSON text of the top-level fields outside ``known``; NULL when there is none."""
    fields = F.from_json(text, "map<string,string>")
    other = F.map_filter(fields, lambda k, _: ~k.isin(*known))
    return F.when(F.size(other) > 0, F.to_json(other))
