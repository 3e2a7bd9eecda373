"""The registered queries and their SQL, by topic; the small ones come first."""

# isort: off
from catalogue import text, lists, ordering, records, pages, vocabulary, tagging, corpus, events
from catalogue.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
_TOPICS = (text, lists, ordering, records, pages, vocabulary, tagging, corpus, events)
