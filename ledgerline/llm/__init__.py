"""Training-data operators: fingerprints, token files, scoring, dedup, sharding, mixing, packing.

Every operator takes DataFrames and returns DataFrames; the thin registered
queries are in ``ledgerline.llm.queries``.  Nothing outside this folder and
``corpus_pipeline.py`` imports it.
"""
