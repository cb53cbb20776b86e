"""ledgerwatch: a Spark-native warehouse loader and fraud-rule engine.

Sub-packages:
  functions/  column expressions (cleansing, names, time arithmetic)
  sources/    file drops, relational sources, test-table mappings
  operators/  watermark capture, SCD2 merge, fact loads, fraud rules
  plans/      named queries, oracle SQL, snapshot store, pipeline
  streaming/  file-drop and rule-3 streaming variants
"""

from ledgerwatch.session import get_session, scratch_dir  # noqa: F401

__all__ = ["get_session", "scratch_dir"]
