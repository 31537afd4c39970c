"""vellum: document indexing and vector retrieval as Spark DataFrame operators.

Main entry points (imported lazily so ``import vellum`` stays cheap)::

    from vellum import VectorStore, discover_files, run_index, topk
"""

__version__ = "0.1.0"

_EXPORTS = {
    "VectorStore": "vellum.sources.store",
    "discover_files": "vellum.sources.files",
    "default_decoders": "vellum.sources.files",
    "plan_index": "vellum.plans.indexing",
    "run_index": "vellum.plans.indexing",
    "IndexConfig": "vellum.plans.indexing",
    "plan_token_ingest": "vellum.plans.indexing",
    "run_token_ingest": "vellum.plans.indexing",
    "topk": "vellum.operators.search",
    "result_view_g1": "vellum.operators.search",
    "result_view_g2": "vellum.operators.search",
    "build_ivf": "vellum.operators.ann",
    "ann_topk": "vellum.operators.ann",
    "HashingEncoder": "vellum.operators.embed",
    "ModelEncoder": "vellum.operators.embed",
    "start_folder_ingest": "vellum.streaming.folder_ingest",
}


def __getattr__(name):
    if name in _EXPORTS:
        import importlib

        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)
