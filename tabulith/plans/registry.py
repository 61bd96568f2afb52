"""All layout queries by name, and their SQL where SQL can express them."""

from tabulith.plans import label_queries as labels
from tabulith.plans import queries as pages
from tabulith.plans import region_queries as regions
from tabulith.plans import table_queries as tables
from tabulith.plans import term_queries as terms

QUERIES = pages.QUERIES | regions.QUERIES | tables.QUERIES | terms.QUERIES | labels.QUERIES


def queries() -> dict:
    return {k: q for k, (q, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in QUERIES.items() if sql}
