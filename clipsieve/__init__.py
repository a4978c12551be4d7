"""Spark-native analytics over tables of short, noisy social-media text.

Every stage is a ``DataFrame -> DataFrame`` function; nothing runs until the caller acts on the result,
apart from the steps that must look at data first (size checks, SVD passes, k-means fits), which say so.
"""

from clipsieve.session import prepare_session
from clipsieve.settings import Settings

__all__ = ["Settings", "prepare_session"]
