"""All training-data queries and their SQL."""

from . import decontamination, exact_dedup, html_text, jaccard_join, language_model, license_scan, packing, quality, toxicity, url_filter

MODULES = (toxicity, decontamination, html_text, license_scan, url_filter, jaccard_join, packing, language_model, exact_dedup, quality)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLES = {k: q for m in MODULES for k, q in m.ORACLES.items()}
