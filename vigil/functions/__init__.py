"""Column -> Column helpers (built-in expressions only)."""

from vigil.functions import dates, geo, text  # noqa: F401
from vigil.functions.stopwords import ENGLISH_STOPWORDS  # noqa: F401
