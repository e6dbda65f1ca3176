"""Column expressions (JVM-side built-ins only; no Python UDFs)."""

from sparkmill.functions.text import (  # noqa: F401
    WHITESPACE_CLASS, clean_text, simple_tokens, whitespace_tokens, remove_stop_words,
)
from sparkmill.functions.weblog import log_fields, parse_log_line, split_protocol  # noqa: F401
from sparkmill.functions.metrics import cosine, squared_error  # noqa: F401
