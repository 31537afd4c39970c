"""Known-content skipping, change detection and last-wins de-duplication
(D3-D5, D7, D8, S9): semi/anti joins and map-side-combined aggregates.

Join sides are left to the planner: with AQE on, a side whose measured size
is under ``spark.sql.autoBroadcastJoinThreshold`` is broadcast at run time,
anything larger is a shuffle join (with skew splitting), so nothing is
broadcast without a proven size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def known_hashes(store: DataFrame, col: str = "file_hash") -> DataFrame:
    """D3: distinct content hashes present in the store (null ignored)."""
    return store.select(col).where(F.col(col).isNotNull()).distinct()


def drop_known(files: DataFrame, known: DataFrame, col: str = "file_hash") -> DataFrame:
    """Files whose content hash is not stored yet, whatever their path.
    The known set is fixed for the run (two new copies are both kept)."""
    return files.join(known.select(col).distinct(), col, "left_anti")


def changed_files(files: DataFrame, state: DataFrame, skip_unchanged: bool = True,
                  path: str = "path", col: str = "file_hash") -> tuple[DataFrame, DataFrame]:
    """(to process, skipped).  A file is skipped when the state holds the
    same hash for its path; with ``skip_unchanged=False`` nothing is skipped.
    The state's rows are compared on ``(path, hash)`` alone; keep contents out of
    ``files`` (see ``indexing.run_index``) where the state can be large."""
    if not skip_unchanged:
        return files, files.limit(0)
    st = state.select(path, col)
    return files.join(st, [path, col], "left_anti"), files.join(st, [path, col], "left_semi")


def unopened_files(listing: DataFrame, seen: DataFrame, state: DataFrame, path: str = "path", col: str = "file_hash") -> DataFrame:
    """D5 by metadata: ``(path, hash)`` of the listed files whose length and time
    of change are those of the last run that read them, and whose hash then is the
    state's now: nobody need open them."""
    same = listing.select(path, "length", "modified").join(seen, [path, "length", "modified"]).select(path, col)
    return same.join(state.select(path, col), [path, col], "left_semi").distinct()


def last_wins(points: DataFrame, key: str = "point_id", order: str = "filepath") -> DataFrame:
    """One row per point id, the one with the greatest ``order`` (the path
    processed last; a null one is before all others).  ``max_by`` is combined map-side, so many copies of one
    content never meet in a single task."""
    others = [c for c in points.columns if c != key]
    best = points.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(order)).alias("__row"))
    return best.select(key, *[F.col("__row")[c].alias(c) for c in others])


def last_wins_by_keys(points: DataFrame, key: str = "point_id", order: str = "filepath") -> DataFrame:
    """D7 for a written table of points: the same rows as ``last_wins``.  Which
    ids have several rows is counted on the key alone; texts and vectors of all
    other rows take part in no aggregation, and stay where they are while Spark can
    broadcast the ids found.  A null key is one key, as in ``last_wins``."""
    several = points.groupBy(F.col(key).alias("__key")).count().where("count > 1").select("__key")
    same = F.col(key).eqNullSafe(F.col("__key"))
    alone = points.join(several, same, "left_anti")
    return alone.unionByName(last_wins(points.join(several, same, "left_semi"), key, order).select(*points.columns))


def stale_points(store: DataFrame, state: DataFrame, path: str = "path", col: str = "file_hash") -> DataFrame:
    """Stored points whose (filepath, file_hash) is not the current state
    of that path (content changed since they were written)."""
    cur = state.select(F.col(path).alias("filepath"), F.col(col).alias("__h"))
    return store.join(cur, (store["filepath"] == cur["filepath"]) & (store[col] == cur["__h"]), "left_anti")


def update_state(state: DataFrame, processed: DataFrame, path: str = "path", col: str = "file_hash") -> DataFrame:
    """``state[path] = hash`` for files that succeeded; every other entry
    (failed, skipped, deleted files) keeps its old value."""
    ok = processed.select(path, F.col(col).alias("__new")).distinct()
    return (
        state.select(path, col)
        .join(ok, path, "full_outer")
        .select(path, F.coalesce(F.col("__new"), F.col(col)).alias(col))
    )
