"""Training-data operators: near-duplicates, mixing, packing, quality, sharding,
extraction, language identification and language-model scoring as Spark jobs.

Nothing else in ``salesnet`` imports this subpackage.  Every operator is a
function ``DataFrame -> DataFrame``; the registered ``opN_*`` queries
(``salesnet.llm.queries``) are thin wrappers over the operators.
"""
