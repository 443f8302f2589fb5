"""Every registered query equals its SQL oracle (DuckDB) on the small tables."""

import pytest

import __spark_entry__ as E
from tests.oracle_util import canonical, duck

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, sf_small, con, name):
    got = QUERIES[name](spark, sf_small).toPandas()
    want = con.execute(SQL[name]).fetchdf()
    c1, r1 = canonical(got)
    c2, r2 = canonical(want)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_what_holds_for_rows(spark, sf_small):
    """Properties beside the SQL; the query without SQL has its check here."""
    from millrace.plans import catalog

    def rows(name):
        return QUERIES[name](spark, sf_small).collect()

    n_turns = spark.read.parquet(f"{sf_small}/conversations.parquet").count()
    encoded = rows("bpe_encode")
    assert len(encoded) == n_turns
    assert all(r["n_tokens"] == (len(r["ids"].split(",")) if r["ids"] else 0) for r in encoded)
    trip = rows("bpe_roundtrip")
    assert len(trip) == n_turns and all(r["roundtrip_ok"] and r["n_oov"] == 0 for r in trip)
    assert {(r["conv_id"], r["turn"]): r["n_tokens"] for r in trip} == {
        (r["conv_id"], r["turn"]): r["n_tokens"] for r in encoded}
    recall = rows("ivf_recall")[0]
    assert recall["n_found"] >= 0.85 * recall["n_queries"]
    for r in rows("packed_samples"):
        assert r["length"] == 1026 and 0 < r["n_tokens"] <= 1026 and 0 <= r["n_loss"] <= r["n_tokens"]
    counts = {r["doc_id"]: r["n_tokens"] for r in rows("bpe_token_counts")}
    chars = {r["doc_id"]: r["n_chars"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    assert counts.keys() == chars.keys() and all(0 < counts[i] for i in chars)
    corpus = set(E.corpus.QUERIES) if E.corpus is not None else set()
    assert set(QUERIES) - set(SQL) - corpus == {"ivf_recall"}
    assert set(catalog.QUERIES) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"question_id", "doc_id", "match_id", "score"}
    assert df.count() >= 0
