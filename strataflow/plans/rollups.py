"""Rollups kept from build to build, so that a mart costs what is new.

Totals add up, so the totals of everything are those of each silver version, merged. A rollup is kept as partial totals: an update totals the silver versions
beyond the ones it has and adds them as a delta; readers merge a base and the deltas since. After ``MAX_DELTAS`` they are folded into a new base.

Entries are named by the silver versions they reach up to: ``<base|delta>/genres=<movie genres>/_version=<ratings>``. Both only rise, so the greatest name
says what is in, and an update that broke off leaves no entry and is made again. Totals per user and genre come from a join, whose
change is the join of the new ratings with all genres, and of the old ratings with the new genres; the latter reads old ratings only when
there are new genres.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from strataflow.operators.metrics import merged_totals
from strataflow.plans.entities import MOVIES, RATINGS, Entity
from strataflow.plans.gold import MODELS, Thresholds
from strataflow.plans.incremental import last_processed
from strataflow.sources.files import drop_path, glob_paths
from strataflow.sources.versions import VERSION_COL, committed_versions, read_versions, version_path, write_version

MAX_DELTAS = 8
BASE, DELTA = "base", "delta"


@dataclass(frozen=True)
class Rollup:
    """A mergeable model over the ratings, and over movie genres if ``by_genre``."""

    name: str
    keys: tuple[str, ...]
    by_genre: bool = False


ROLLUPS = {
    r.name: r
    for r in (
        Rollup("rollup_movies", ("movie_id",)),
        Rollup("rollup_days", ("event_date", "rating")),
        Rollup("rollup_users", ("user_id",)),
        Rollup("rollup_user_genres", ("user_id", "genre"), by_genre=True),
    )
}

#: (genres, ratings): the silver versions an entry reaches up to; -1 before the first.
Mark = tuple[int, int]
NOTHING: Mark = (-1, -1)


def rollup_path(base: str, name: str) -> str:
    return f"{base}/rollups/{name}"


def _folder(base: str, name: str, kind: str, genres: int) -> str:
    return f"{rollup_path(base, name)}/{kind}/genres={genres}"


def entries(spark: SparkSession, base: str, name: str) -> dict[str, list[Mark]]:
    """The committed entries of a rollup by kind, in order."""
    found: dict[str, list[Mark]] = {BASE: [], DELTA: []}
    for marker in glob_paths(spark, f"{rollup_path(base, name)}/*/genres=*/{VERSION_COL}=*/_SUCCESS"):
        kind, genres, version = marker.rsplit("/", 4)[1:4]
        found[kind].append((int(genres.split("=")[1]), int(version.split("=")[1])))
    return {kind: sorted(marks) for kind, marks in found.items()}


def _live(found: dict[str, list[Mark]]) -> list[tuple[str, Mark]]:
    """The newest base, if any, and the deltas beyond it."""
    start = found[BASE][-1] if found[BASE] else NOTHING
    return [(BASE, m) for m in found[BASE][-1:]] + [(DELTA, m) for m in found[DELTA] if m > start]


def mark_of(found: dict[str, list[Mark]]) -> Mark:
    return max([*found[BASE], *found[DELTA]], default=NOTHING)


def _totals(rollup: Rollup, ratings: DataFrame, genres: DataFrame | None) -> DataFrame:
    """The rollup's own model over some versions of its inputs."""
    tables = {RATINGS.table_cleaned: ratings, MOVIES.table_features: genres}

    def ref(name: str) -> DataFrame:
        return tables[name] if name in tables else MODELS[name].build(ref, Thresholds())

    return ref(rollup.name)


def _read(spark: SparkSession, entity: Entity, path: str, schema: str, after: int, upto: int) -> DataFrame | None:
    versions = [v for v in committed_versions(spark, path) if after < v <= upto]
    return read_versions(spark, path, versions, schema) if versions else None


def pending(spark: SparkSession, base: str, name: str, upto: Mark) -> DataFrame | None:
    """The totals that bring a rollup from its mark up to ``upto``; None if it is there."""
    rollup, (genres, ratings) = ROLLUPS[name], mark_of(entries(spark, base, name))
    rated = lambda a, b: _read(spark, RATINGS, RATINGS.cleaned_path(base), RATINGS.cleaned_schema, a, b)
    listed = lambda a, b: _read(spark, MOVIES, MOVIES.features_path(base), MOVIES.features_schema, a, b)
    new = rated(ratings, upto[1])
    if not rollup.by_genre:
        return None if new is None else _totals(rollup, new, None)
    parts = []
    for some_ratings, some_genres in ((new, listed(-1, upto[0])), (rated(-1, ratings), listed(genres, upto[0]))):
        if some_ratings is not None and some_genres is not None:
            parts.append(_totals(rollup, some_ratings, some_genres))
    return reduce(DataFrame.unionByName, parts) if parts else None


def update(spark: SparkSession, base: str, max_deltas: int = MAX_DELTAS) -> dict[str, Mark]:
    """Bring every rollup up to the silver tables; returns how far each one reaches.

    Only versions of complete runs count: what a broken run left behind may still be taken back.
    """
    upto = tuple(-1 if v is None else v for v in (last_processed(spark, MOVIES, base), last_processed(spark, RATINGS, base)))
    reached = {}
    for name, rollup in ROLLUPS.items():
        goal: Mark = upto if rollup.by_genre else (0, upto[1])
        delta = pending(spark, base, name, goal)
        if delta is not None:
            merged = merged_totals(delta, rollup.keys) if rollup.by_genre else delta
            write_version(merged, _folder(base, name, DELTA, goal[0]), goal[1])
        _fold(spark, base, name, max_deltas)
        reached[name] = mark_of(entries(spark, base, name))
    return reached


def _fold(spark: SparkSession, base: str, name: str, max_deltas: int) -> None:
    """Fold the deltas into a new base. The base before and its deltas stay for readers that are still at them; what is older goes."""
    found = entries(spark, base, name)
    live = _live(found)
    if sum(kind == DELTA for kind, _ in live) < max_deltas:
        return
    genres, ratings = mark_of(found)
    write_version(read_rollup(spark, base, name), _folder(base, name, BASE, genres), ratings)
    before = found[BASE][-1] if found[BASE] else NOTHING
    for kind, marks in found.items():
        for g, r in marks:
            if (g, r) < before or (kind == DELTA and (g, r) == before):
                drop_path(spark, version_path(_folder(base, name, kind, g), r))


def read_rollup(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The totals of everything a rollup has, one row per key."""
    live = _live(entries(spark, base, name))
    if not live:
        raise ValueError(f"{name} has no entries under {base}")
    parts = [read_versions(spark, _folder(base, name, kind, g), [r]) for kind, (g, r) in live]
    if len(parts) == 1:
        return parts[0]
    return merged_totals(reduce(DataFrame.unionByName, parts), ROLLUPS[name].keys)


def stored_rollups(spark: SparkSession, base: str) -> dict[str, Callable[[], DataFrame]]:
    """Every rollup that has entries, to be read in place of its model."""
    return {
        name: lambda n=name: read_rollup(spark, base, n) for name in ROLLUPS if mark_of(entries(spark, base, name)) != NOTHING
    }
