"""Training-data operators: WARC writing, mixing, near-duplicates, quotation
linking, token counts, personal data, fuzzy passages, benchmark
decontamination, toxicity and quality rules.  Nothing outside this package
imports it except the guarded registration in ``__spark_entry__``."""
