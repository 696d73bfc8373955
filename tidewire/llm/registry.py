"""All registered queries of this subpackage."""

from tidewire.llm import queries_flow, queries_ids, queries_repeats, queries_rules, queries_text

_PARTS = (queries_ids, queries_rules, queries_flow, queries_text, queries_repeats)
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
