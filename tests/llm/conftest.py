import pytest


@pytest.fixture(scope="session")
def lspark(spark):
    from stratum.llm.frames import ship_package

    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def frame(lspark):
    """docs(texts) -> DataFrame with doc_id 0.. and columns whose names clash with results."""
    def make(rows, schema="doc_id long, text string, score string, n string, id string, t string, "
                          "h string, key string, rep string, row string, _s string"):
        width = len(schema.split(","))
        full = [tuple(r) + ("x",) * (width - len(r)) for r in rows]
        return lspark.createDataFrame(full, schema)

    return make


def numbered(texts):
    return list(enumerate(texts))


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
