"""Training-data operators: decontamination, URL rules, vector search, near duplicates, quality
classification, source mixing, language-model scoring, archive conversion, secrets, sharding.

Nothing outside this subpackage imports it; ``corpus_pipeline.py`` chains five of the operators.
"""
