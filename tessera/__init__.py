"""tessera: keyed multi-caption corpora with dense vectors, prepared and evaluated on Spark.

Subpackages:

- ``functions``  pure Column expressions (tokenizers, markers, padding, n-grams)
- ``sources``    readers, caches and the stand-in tables used by the tests
- ``operators``  DataFrame -> DataFrame operators (split, vocabulary, batches, k-NN, BLEU, ...)
- ``plans``      end-to-end compositions and the query registry
- ``streaming``  Structured Streaming variants of the batch operators
"""

from tessera.session import checkpoint_scope, ensure_checkpoint_dir, get_session

__all__ = ["get_session", "ensure_checkpoint_dir", "checkpoint_scope"]
