from tablelearn.functions.exprs import (  # noqa: F401
    is_missing, nan_to_null, order_hash, hash_bucket, round_doubles, numeric_columns, vec_sqdist,
)
