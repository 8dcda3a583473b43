"""Build column-expression lists once per JVM.

A Column is an unresolved expression, resolved separately in every plan that
uses it, so the same objects can serve every query.  Building wide
projections costs hundreds of Python-to-JVM calls; caching them keeps
per-query driver time flat.
"""

from __future__ import annotations

from functools import wraps


def per_jvm(fn):
    cache: dict = {}

    @wraps(fn)
    def wrapper(*args):
        from pyspark import SparkContext
        key = (id(SparkContext._jvm),) + args
        if key not in cache:
            cache[key] = fn(*args)
        return cache[key]

    return wrapper
