"""Column expressions shared by the operators (all JVM-side built-ins)."""

from spark_recs.functions.columns import (  # noqa: F401
    canonical_item, day, dot, hash_key, hash_unit, split_is_train, split_is_val)
