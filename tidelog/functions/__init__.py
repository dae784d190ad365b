from tidelog.functions.offset_json import decode_offsets, encode_offsets, encode_topics
from tidelog.functions.payload import is_tombstone, json_field, text

__all__ = [
    "decode_offsets",
    "encode_offsets",
    "encode_topics",
    "is_tombstone",
    "json_field",
    "text",
]
