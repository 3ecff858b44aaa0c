from .buckets import bucketize
from .hashing import hash_below
from .text import as_message, route_name

__all__ = ["as_message", "bucketize", "hash_below", "route_name"]
