"""wordloom: corpus modelling and QA evaluation as Spark DataFrame operators.

Public entry points::

    from wordloom.operators import ngram, bpe, qa, scoring
    from wordloom.sources import files
    from wordloom.streaming import ngram_stream
    from wordloom.session import local_session, ensure_checkpoint_dir
"""

__all__ = ["functions", "operators", "plans", "session", "sources", "streaming"]
