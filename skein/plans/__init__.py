"""Registered queries over the driver tables and their SQL oracles."""


def all_queries():
    """Name -> ``(spark, sf_dir) -> DataFrame`` for every registered query."""
    from skein.plans.catalog import BATCH_QUERIES
    from skein.plans.streams import STREAM_QUERIES

    return {**BATCH_QUERIES, **STREAM_QUERIES}


def all_oracles():
    """Name -> DuckDB SQL for every query that SQL can express."""
    from skein.plans.oracle import ORACLE_SQL

    return dict(ORACLE_SQL)
