"""Column-level building blocks (all JVM-side expressions)."""

from utterspark.functions.text import (  # noqa: F401
    WHITESPACE_CHARS, clean_text, strip_punct, tokenize_ws, tokenize_mixed, ws_class,
)
from utterspark.functions.arrays import (  # noqa: F401
    softmax, argmax, array_max_value, top_k, dot_rows, sigmoid_normalised,
)
