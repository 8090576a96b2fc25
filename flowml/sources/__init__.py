from flowml.sources.flows import (parse_csv_lines, parse_csv_strict, read_encoded,
                                  read_flow_rejects, read_flows)
from flowml.sources.stream import message_batch, message_stream

__all__ = ["parse_csv_lines", "parse_csv_strict", "read_flows", "read_flow_rejects",
           "read_encoded", "message_stream", "message_batch"]
