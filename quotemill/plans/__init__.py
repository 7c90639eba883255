"""Plans: operators put together as the registered queries."""


def load_queries():
    """(queries, oracle SQL) of the market operators, by ID."""
    from quotemill.plans import core_queries, source_queries, study_queries, trade_queries  # noqa: F401
    from quotemill.plans.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
