"""The queries of this subpackage, and SQL for those that SQL can express."""

from . import alignment, chat, embeddings, fingerprints, jaccard, language_model, mixing, outliers, packing, pii, quality, resampling, token_files

_MODULES = (packing, chat, embeddings, fingerprints, mixing, pii, language_model, quality, jaccard, token_files, resampling, outliers, alignment)

QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
ORACLES = {k: s for m in _MODULES for k, s in m.ORACLES.items()}
