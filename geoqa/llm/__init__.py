"""Operators of a training-data pipeline: token counts, main-text extraction,
language-model scores, substring and near-duplicate removal, quality rules,
toxicity, benchmark decontamination, license scans and sequence packing."""
