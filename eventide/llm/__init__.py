"""Training-data operators: URL filtering, toxicity, packing, WARC, decontamination, secret scans,
SimHash near-dedup, substring and suffix-array dedup, and robust quality rules.

Each operator module takes and returns DataFrames and names its own edge cases;
``queries`` registers one whole-table query per operator.  Nothing outside this
subpackage (and ``corpus_pipeline.py``) imports it.
"""
