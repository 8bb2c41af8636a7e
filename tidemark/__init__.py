"""Layered (raw -> staging -> silver -> curated -> star schema -> KPI) data jobs on PySpark.

Every operator is a plain function from DataFrames to DataFrames; readers and
writers live in ``tidemark.sources`` and nothing else touches storage.
"""
