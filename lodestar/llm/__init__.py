"""Training-data operators: extraction, language, toxicity, duplicates,
decontamination, scoring and token output.  Nothing outside this folder (and
``corpus_pipeline.py``) imports it."""
