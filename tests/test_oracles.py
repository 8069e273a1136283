"""Every registered query of the engine against its DuckDB twin on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from cytolake import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return float(v) if hasattr(v, "as_tuple") else v


def table(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, duck, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    want = duck.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({catalog.ORACLES[name]})")
    assert sorted(duck.sql(catalog.ORACLES[name]).columns) == cols
    assert table(df.select(*[f"`{c}`" for c in cols]).collect()) == table(want.fetchall())


def test_every_query_is_checked_somewhere():
    rows_only = set(catalog.QUERIES) - set(catalog.ORACLES)
    assert rows_only == {"connectivities", "pca_projection", "metacell_kmeans", "louvain_clusters", "diffusion_pseudotime", "doublet_scores", "harmony_embedding", "hierarchical_clones"}


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["cluster", "count", "mean", "median", "std"]
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
