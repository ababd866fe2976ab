"""The table of registered queries. A query is a function of (spark, sf_dir); its SQL, where there is one, is the oracle."""

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register
