"""Column-level helpers: key texts, portable hashes, look-ups."""

from .hashing import bucket, digest_pair, rank_hash
from .keys import key_part_text, key_text, seeded
from .lookup import lookup_join, map_lookup, mapping_frame

__all__ = [
    "bucket",
    "digest_pair",
    "rank_hash",
    "key_part_text",
    "key_text",
    "seeded",
    "lookup_join",
    "map_lookup",
    "mapping_frame",
]
