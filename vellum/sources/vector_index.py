"""A point store that carries its own search index.

The points lie in the cells of an IVF index instead of buckets by content: the
cell is the partition column, the centres and the number of cells to probe lie
beside them.  An upsert puts each point into its cell and takes a replaced id out
of whichever cell held it; a search lists the files of probed cells only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.operators import ann
from vellum.sources.store import VectorStore, _exists


class IndexedStore(VectorStore):
    """``VectorStore`` whose bucket is the cell of the vector."""

    moves = True  # an id goes to another bucket with another vector

    @property
    def index_path(self) -> str:
        return f"{self.root}/index"

    def ensure_index(self, centres: list[list[float]], probes: int, schema: T.StructType | None = None) -> "IndexedStore":
        """Create the collection with these cells if absent; an existing one is
        left untouched."""
        if not _exists(self.spark, self.meta_path):
            ann._check_centres(centres)
            rows = [(i, [float(x) for x in c]) for i, c in enumerate(centres)]
            self.spark.createDataFrame(rows, "cell int, centre array<double>").coalesce(1).write.mode("overwrite").parquet(self.index_path)
            self._new_buckets = len(centres)
            self.ensure(len(centres[0]), schema, more={"probes": int(probes)})
        return self

    def fit_index(self, points: DataFrame, *, goal: float = 0.9, k: int = 5, cells: int | None = None, schema: T.StructType | None = None) -> "IndexedStore":
        """``ensure_index`` with cells and probes fitted on a sample of ``points``
        (see ``ann.fit_ivf``)."""
        if _exists(self.spark, self.meta_path):
            return self
        index, probes = ann.fit_ivf(points, goal=goal, k=k, cells=cells)
        return self.ensure_index(index.centres, probes, schema)

    def centres(self) -> list[list[float]]:
        if getattr(self, "_centres", None) is None:
            self._centres = [list(r["centre"]) for r in self.spark.read.parquet(self.index_path).orderBy("cell").collect()]
        return self._centres

    def _place(self, points: DataFrame) -> DataFrame:
        return ann.probe_cells(points, self.centres(), 1, "vector").withColumnRenamed("cell", "bucket")

    def search(self, queries: DataFrame, k: int | str = 5, *, probes: int | None = None, threshold=None, query_id: str = "query_id",
               query_vec: str = "vector", query_filter: str | None = None, point_filter: str | None = None,
               payload: list[str] | None = None, scored=None) -> DataFrame:
        """The ``k`` best points per query of its ``probes`` closest cells (as many as
        the store was fitted to, unless given); output as ``search.topk``."""
        probes = min(probes or int(self.meta()["probes"]), self.buckets)
        cells = ann.probe_cells(queries.where(F.col(query_vec).isNotNull()).select(query_vec), self.centres(), probes, query_vec).select("cell").distinct()
        probed = sorted(r[0] for r in cells.collect())  # at most the number of cells
        points = self._read(probed).withColumnRenamed("bucket", "cell")
        return ann.ann_topk(ann.open_ivf(self.centres(), points), queries, k, nprobe=probes, threshold=threshold, query_id=query_id,
                            query_vec=query_vec, query_filter=query_filter, point_filter=point_filter, payload=payload, scored=scored)
