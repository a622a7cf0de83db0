from .text import blank_to_null, Field, standardize, unparseable  # noqa: F401
from .expr import bucketize, decode, end_of_month, pass_rate, batch_id, money_text, hex_text  # noqa: F401
