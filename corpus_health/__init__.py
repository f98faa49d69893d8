"""Corpus health: Spark operators that measure and govern large document estates.

Every operator takes DataFrames and plain parameters and returns a DataFrame;
nothing runs until the caller asks for a result.
"""

from corpus_health.params import Params

__all__ = ["Params"]
