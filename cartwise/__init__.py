"""cartwise — purchase-prediction features and modelling on Spark.

Subpackages
-----------
sources    typed readers, the TPC-H-to-basket adapter, writers and catalog helpers
functions  column helpers (guarded ratios, hash order keys, size-checked broadcast,
           skew-safe sequencing)
operators  feature build, quality checks, labels and sampling, metrics, scoring,
           plot data
plans      Spark ML pipelines, search, cross-validation, ensemble, model selection,
           experiment run table, end-to-end batch plans
streaming  micro-batch scoring of request files with Structured Streaming
"""

from cartwise.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
