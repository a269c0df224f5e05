"""Operators for large training corpora: packing, quality rules, token counts,
language-model scoring, language ID, archives, near-duplicates, decontamination,
HTML extraction, chat formatting, document fingerprints, conversation tries and
tokenizer alignment. Nothing outside this package imports it."""
