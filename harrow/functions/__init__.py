from harrow.functions.hashing import stable_hash, unit_interval  # noqa: F401
from harrow.functions.text import strip_quotes, tokenize  # noqa: F401
