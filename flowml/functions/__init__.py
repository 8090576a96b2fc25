from flowml.functions.hashing import hash_u32, hash_uniform
from flowml.functions.messages import (conn_to_flow, flatten_conn, parse_messages,
                                       rename_struct, to_message_value, wrap_message)

__all__ = ["hash_u32", "hash_uniform", "parse_messages", "rename_struct", "flatten_conn",
           "conn_to_flow", "wrap_message", "to_message_value"]
