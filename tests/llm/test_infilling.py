import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tripstats.llm import infilling as I
from tripstats.llm import queries

from .brute import sha


def by_hand(doc_id, text, how):
    text = text or ""
    digest = hashlib.sha256(f"{how.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in how.markers) or h3 % 100 >= 100 - how.plain_percent:
        return doc_id, n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < how.spm_percent:
        return doc_id, n, "spm", a, b - a, how.suffix + s + how.prefix + p + how.middle + m
    return doc_id, n, "psm", a, b - a, how.prefix + p + how.suffix + s + how.middle + m


EXTRA = [
    (101, "a$1\\b{2}\n\r \x85>" * 9),
    (102, "<P" * 3000 + ">"),
    (103, "S>" * 4000),
    (104, "\U0001f600é́" * 9000),  # over a block of units, two of them outside the basic plane
    (105, "x" * I.BLOCK),
    (106, "y" * (3 * I.BLOCK)),
    (107, "z" * (I.BLOCK - 1)),
    (108, "keeps <M> inside"),
    (109, "\x00nul"),
    (110, "l" * 700_000),
]


@pytest.mark.parametrize(
    "how",
    [
        I.Infilling(),
        I.Infilling(plain_percent=0, spm_percent=0),
        I.Infilling(plain_percent=0, spm_percent=100, seed=7),
        I.Infilling(plain_percent=100),
        I.Infilling(prefix="$1{", suffix="\\E(", middle="[^.*"),
    ],
)
def test_matches_brute_force_and_comes_back(spark, edge_rows, edge_docs, how):
    extra = spark.createDataFrame(EXTRA, "doc_id long, text string")
    rows = [(r[0], r[1]) for r in edge_rows] + EXTRA
    out = I.infill(edge_docs.select("doc_id", "text").unionByName(extra), how)
    out = out.withColumn("back", I.restored(F.col("output"), F.col("form"), how)).collect()
    assert all(r.back == r.text for r in out)
    found = sorted(str((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in out)
    assert found == sorted(str(by_hand(d, t, how)) for d, t in rows)


def test_digests_match_sql(spark, edge_docs, small_docs):
    for docs in (edge_docs, small_docs):
        con = duckdb.connect()
        con.register("documents", docs.select("doc_id", "text").toArrow())
        want = sorted(map(str, con.execute(I.INFILL_SQL).fetchall()))
        assert sorted(map(str, map(tuple, I.infill_digests(docs).collect()))) == want


def test_output_is_the_text_with_markers(small_docs):
    rows = I.infill(small_docs).collect()
    for r in rows:
        assert len(r.output) == r.n + (0 if r.form == "plain" else 9)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_empty_table(spark, empty_docs):
    got = I.infill_digests(empty_docs)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert got.count() == 0


def test_markers_whose_ends_meet_are_refused():
    for bad in (("<P>", "<S>", ">M<"), ("<P>", "<P>x", "<M>"), ("aba", "<S>", "<M>"), ("", "<S>", "<M>"), ("<P>", "[<P>]", "<M>"), ("<P>", "<P>", "<M>")):
        with pytest.raises(ValueError):
            I.Infilling(*bad)


def test_one_narrow_stage_without_python(spark):
    plan = queries.op11_counted_infilling(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and not any(x in plan for x in ("Python", "Pandas", "Arrow", "ScalaUDF"))


def test_restored_digest_is_that_of_the_text(edge_docs, edge_rows):
    got = sorted((str(r.doc_id), r.restored_sha256) for r in I.infill_digests(edge_docs).collect())
    assert got == sorted((str(r[0]), sha(r[1] or "")) for r in edge_rows)
