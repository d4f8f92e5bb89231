import duckdb
import pytest
from pyspark.sql import functions as F

from tripstats.llm import mixing as M
from tripstats.llm import queries

MIXES = [
    M.Mix(),
    M.Mix(budget_share=0.3, max_epochs=1),
    M.Mix(budget_share=5.0, max_epochs=3),  # more than there is
    M.Mix(weights={"domain": {"web": 1.0, "books": 0.0}, "lang": {"en": 3.0}, "source": {"src1": 9.0, "src4": 0.0}}, default=0.5),
    M.Mix(budget_share=0.0),
]


@pytest.mark.parametrize("mix", MIXES)
def test_matches_sql(spark, edge_docs, mix):
    small = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for docs, table in ((small, None), (edge_docs, edge_docs.select("doc_id", "text", "lang", "source").toArrow())):
        con = duckdb.connect()
        if table is None:
            con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
        else:
            con.register("documents", table)
        cur = con.execute(M.mixture_sql(mix))
        names = [d[0] for d in cur.description]
        found = M.mixture(docs, mix).select(names).collect()
        assert sorted(map(str, map(tuple, found))) == sorted(map(str, cur.fetchall()))


def test_budgets(spark):
    """Full leaves, then siblings, then the parents' siblings."""
    leaves = [("web", "en", "src0", 100), ("web", "en", "src3", 1000), ("web", "de", "src0", 50), ("books", "en", "src1", 10_000)]
    rows = spark.createDataFrame(leaves, "domain string, lang string, source string, n_tokens long")
    mix = M.Mix(weights={"domain": {"web": 0.5, "books": 0.5}, "lang": {"en": 0.5, "de": 0.5}, "source": {}}, budget_share=1000 / 11150, max_epochs=1)
    got = {(r.domain, r.lang, r.source): r.budget for r in M.leaf_budgets(rows, mix).collect()}
    # web gets 500: de can take 50 only, en takes the other 450, of which src0 can take 100.
    assert got == {("web", "de", "src0"): 50, ("web", "en", "src0"): 100, ("web", "en", "src3"): 350, ("books", "en", "src1"): 500}
    more = M.Mix(weights=mix.weights, budget_share=4000 / 11150, max_epochs=1)
    got = {(r.domain, r.lang, r.source): r.budget for r in M.leaf_budgets(rows, more).collect()}
    assert got == {("web", "de", "src0"): 50, ("web", "en", "src0"): 100, ("web", "en", "src3"): 1000, ("books", "en", "src1"): 2850}


def test_take_mixture_returns_the_documents(edge_docs, empty_docs):
    mix = M.Mix(budget_share=0.7, max_epochs=1)
    taken = M.take_mixture(edge_docs, mix)
    assert taken.columns == edge_docs.columns
    want = sorted(str(r.doc_id) for r in M.mixture(edge_docs, mix).collect())
    assert sorted(str(r.doc_id) for r in taken.collect()) == want
    assert M.mixture(empty_docs).count() == 0 and M.take_mixture(empty_docs).count() == 0


def test_token_totals_come_near_the_budget(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mix = M.Mix()
    by_leaf = M.mixture(docs, mix).groupBy(*M.LEVELS).agg(F.sum("n_tokens").alias("taken"), F.max("n_tokens").alias("most"))
    budgets = M.leaf_budgets(M._narrow(docs, mix), mix)
    for r in budgets.join(by_leaf, list(M.LEVELS), "left").collect():
        taken = r.taken or 0
        assert r.budget <= taken + 0 or r.budget == 0
        assert taken - r.budget <= (r.most or 0)


def test_no_python_in_the_plan(spark):
    plan = queries.op8_mixing_budgets(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ScalaUDF"))
