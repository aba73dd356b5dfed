"""Column expressions shared by the operators (all JVM-side built-ins)."""

from graphcluster.functions.priority import beats, hash_priority, sql_hash_priority

__all__ = ["beats", "hash_priority", "sql_hash_priority"]
