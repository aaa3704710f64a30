"""Training-data operators: decontamination, dedup, scoring, tokenisation and joins at corpus scale.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
