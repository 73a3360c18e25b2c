"""Training-data operators: deduplication, token counts, PII surrogates, decontamination, language-model
scores, nearest neighbours, quality labels, URL rules, SimHash groups and byte-level BPE."""
