"""Medallion lakehouse jobs for a question-and-answer community, on Spark.

Raw yearly extracts become canonical history tables (silver) and aggregate
marts (gold). Every operator takes and returns DataFrames; side effects live in
``plans.store`` and ``plans.jobs``.
"""
