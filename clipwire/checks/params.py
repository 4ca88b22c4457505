"""Parameters shared by the registered queries and their SQL twins."""

import datetime as dt

KEYWORDS = ("license", "genes", "für", "ción")
PT_KEYWORDS = ("licença", "genes", "für", "ción")
STRICT_KEYWORDS = ("license", "genes", "für", "que")
SEARCH = ("license", "the of")
STOPWORDS = ("the", "of", "and", "de", "la", "der", "die", "que", "le", "und", "für")

STAMP = dt.date(2024, 1, 31)
TODAY = dt.date(2024, 2, 1)
PRODUCER_TO = "2024-01-02T12:00:00"
PRODUCER_DAYS = 1
REWRITE_TO = "2024-01-03T00:00:00"
PAGE_SIZE = 10
FILES_PER_BATCH = 2
