from stratavault.functions import keys, parsing, scalars

__all__ = ["keys", "parsing", "scalars"]
