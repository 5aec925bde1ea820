"""Registry of (query, comparison SQL) pairs."""

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    """Register a ``(spark, sf_dir) -> DataFrame`` callable, with its SQL where there is one."""

    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register
