"""Column-expression helpers (all JVM-side, codegen friendly)."""

from lathe.functions.exprs import round_doubles, safe_ratio, to_double_nullable
from lathe.functions.hashing import hash_fold, key_hash, key_hash_u32

__all__ = [
    "hash_fold",
    "key_hash",
    "key_hash_u32",
    "round_doubles",
    "safe_ratio",
    "to_double_nullable",
]
