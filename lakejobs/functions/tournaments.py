"""Class, weight and rating factor of a match's tournament, looked up by its exact name."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tournament:
    kind: str
    weight: float
    k_factor: float


# The tournaments of the match table; callers with other names pass their own mapping.
TOURNAMENTS = {
    "FIFA World Cup": Tournament("World Cup", 1.0, 60.0),
    "FIFA World Cup qualification": Tournament("WC Qualifier", 0.7, 40.0),
    "Copa América": Tournament("Continental Final", 0.85, 50.0),
    "UEFA Nations League": Tournament("Nations League", 0.65, 40.0),
    "Friendly": Tournament("Friendly", 0.4, 20.0),
}
UNKNOWN = Tournament("Other", 0.5, 30.0)


def _looked_up(name: Column | str, field: str, known: Mapping[str, Tournament], other: Tournament) -> Column:
    """Value of ``field`` from a literal map; names that are not in it, and NULL, get ``other``'s."""
    column = F.col(name) if isinstance(name, str) else name
    pairs = F.create_map(*[F.lit(x) for key, t in known.items() for x in (key, getattr(t, field))])
    return F.coalesce(F.try_element_at(pairs, column), F.lit(getattr(other, field)))


def tournament_type(name: Column | str, known: Mapping[str, Tournament] = TOURNAMENTS, other: Tournament = UNKNOWN) -> Column:
    return _looked_up(name, "kind", known, other)


def tournament_weight(name: Column | str, known: Mapping[str, Tournament] = TOURNAMENTS, other: Tournament = UNKNOWN) -> Column:
    return _looked_up(name, "weight", known, other)


def k_factor(name: Column | str, known: Mapping[str, Tournament] = TOURNAMENTS, other: Tournament = UNKNOWN) -> Column:
    return _looked_up(name, "k_factor", known, other)
