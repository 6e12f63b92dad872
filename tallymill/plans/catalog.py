"""Named queries, each with the SQL that checks it where SQL can express it."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register ``f(spark, sf_dir) -> DataFrame`` under ``name``."""
    def register(f):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register
