"""Gold builds: models by name or tag, lazily for reading or stored as tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from strataflow.plans.entities import ENTITIES
from strataflow.plans.gold import MODELS, Model, Thresholds, in_order
from strataflow.plans.incremental import read_cleaned, read_features
from strataflow.plans.rollups import stored_rollups, update
from strataflow.session import apply_defaults, sized_shuffle
from strataflow.sources.catalog import register_snapshot
from strataflow.sources.files import drop_path, new_scratch, path_exists, size_of
from strataflow.sources.versions import drop_older, next_version, read_since, write_version

# Read by several marts, small next to the ratings: worth storing during a build.
SHARED = ("rollup_movies", "rollup_days", "int_movie_metrics", "int_genre_metrics")


def resolver(
    tables: Mapping[str, Callable[[], DataFrame]],
    thresholds: Thresholds = Thresholds(),
    store: Callable[[str, DataFrame], DataFrame] | None = None,
) -> Callable[[str], DataFrame]:
    """``ref`` over silver ``tables``: a model is built on first use, its inputs before it."""
    built: dict[str, DataFrame] = {}

    def ref(name: str) -> DataFrame:
        if name not in built:
            if name in tables:
                built[name] = tables[name]()
            elif name in MODELS:
                df = MODELS[name].build(ref, thresholds)
                built[name] = store(name, df) if store and name in SHARED else df
            else:
                raise KeyError(f"no model or silver table {name!r}")
        return built[name]

    return ref


def silver_tables(spark: SparkSession, base: str) -> dict[str, Callable[[], DataFrame]]:
    tables: dict[str, Callable[[], DataFrame]] = {}
    for entity in ENTITIES.values():
        tables[entity.table_cleaned] = lambda e=entity: read_cleaned(spark, e, base)
        tables[entity.table_features] = lambda e=entity: _features(spark, e, base)
    return tables


def _features(spark: SparkSession, entity, base: str) -> DataFrame:
    """Stored features, or the same computed from the cleaned table where the entity does not store them."""
    if entity.run_features:
        return read_features(spark, entity, base)
    return entity.build_features(read_cleaned(spark, entity, base))


def selected(select: str | None) -> list[Model]:
    """Models of a name or of ``tag:<tag>``; all of them without a selection."""
    if not select:
        return [m for m in MODELS.values() if m.layer != "rollup"]
    if select.startswith("tag:"):
        chosen = [m for m in MODELS.values() if select.removeprefix("tag:") in m.tags]
    else:
        chosen = [MODELS[select]] if select in MODELS else []
    if not chosen:
        raise ValueError(f"no model matches {select!r}")
    return chosen


def build(
    spark: SparkSession,
    base: str,
    select: str | None = None,
    thresholds: Thresholds = Thresholds(),
    database: str | None = "gold",
    threads: int = 4,
    incremental: bool = False,
) -> dict[str, str]:
    """Build the selected models from the silver tables under ``base``, with ``incremental`` from rollups that are kept and only brought up to date.

    Marts are stored as Parquet under ``gold/`` and registered in ``database``;
    the other models become temporary views. Marts are written ``threads`` at a
    time, so that small ones do not leave the cluster idle. Returns ``{model: path or view}``.
    """
    apply_defaults(spark)
    silver = f"{base}/silver"
    with sized_shuffle(spark, size_of(spark, [silver]) if path_exists(spark, silver) else 0):
        tables = silver_tables(spark, base)
        if incremental:
            update(spark, base)
            tables.update(stored_rollups(spark, base))
        return _build(spark, base, select, thresholds, database, threads, tables)


def _build(
    spark: SparkSession,
    base: str,
    select: str | None,
    thresholds: Thresholds,
    database: str | None,
    threads: int,
    tables: Mapping[str, Callable[[], DataFrame]],
) -> dict[str, str]:
    scratch = new_scratch(spark, "gold-build")

    def store(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    def write_mart(item: tuple[str, DataFrame]) -> str:
        name, df = item
        path = f"{base}/gold/{name}"
        version = next_version(spark, path)
        write_version(df, path, version)
        if database:
            register_snapshot(spark, f"{database}.{name}", path, version)
        # The one before stays for readers that are still at it.
        drop_older(spark, path, keep=2)
        return path

    stored_ref = resolver(tables, thresholds, store)
    view_ref = resolver(tables, thresholds)
    models = selected(select)
    results: dict[str, str] = {}
    for model in models:
        if not model.stored:
            view_ref(model.name).createOrReplaceTempView(model.name)
            results[model.name] = model.name
    try:
        # Building the frames stores what the marts share; after that they are independent.
        marts = [(m.name, stored_ref(m.name)) for m in models if m.stored]
        with ThreadPoolExecutor(threads) as pool:
            results.update(zip((name for name, _ in marts), pool.map(write_mart, marts)))
    finally:
        drop_path(spark, scratch)
    return results


def read_mart(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A stored mart in its reading order."""
    return in_order(name, read_since(spark, f"{base}/gold/{name}", snapshot="latest"))
