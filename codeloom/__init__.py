"""codeloom: map raw institution codes onto a canonical taxonomy, and score the mapping, on Spark."""

__version__ = "0.1.0"
