import duckdb
import pytest

import corpus_pipeline as C
from tripstats.llm import mixing, quality
from tripstats.llm.queries import vocabulary
from tripstats.llm.shared import stored

from . import brute
from .test_packing import check as check_pieces

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(docs):
    return sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)


@pytest.mark.parametrize("which", ["small", "edges"])
def test_every_stage_against_brute_force_on_its_own_input(spark, small_docs, edge_docs, which):
    from tokenizers import Tokenizer

    docs = small_docs if which == "small" else edge_docs
    columns = docs.columns
    assert [n for n, _ in C.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mix_sources", "pack_sequences"]
    found = [docs]
    for name, stage in C.STAGES:
        found.append(stored(stage(spark, found[-1], "unused"), f"test-{name}"))
        if name != "pack_sequences":
            assert found[-1].columns == columns and found[-1].dtypes == docs.dtypes
    rows = [rows_of(d) for d in found[:5]]

    kept = {str((r.doc_id, r.n_words, r.word_chars)): r.kept for r in quality.judge(docs).collect()}
    assert rows[1] == [(d, t) for d, t in rows[0] if kept[str((d, *brute.quality_counts(t)[:2]))]]

    assert sorted((str(d), brute.sha(t or "")) for d, t in rows[2]) == sorted((str(d), s) for d, _, _, s in brute.line_dedup(rows[1]))

    classes = brute.near_classes(rows[2])
    ids = [d for d, _ in rows[3]]
    assert sorted(d for d in ids if d is not None) == sorted(set(classes.values()))

    con = duckdb.connect()
    con.register("documents", found[3].select("doc_id", "text", "lang", "source").toArrow())
    want = con.execute(f"SELECT doc_id FROM ({mixing.mixture_sql(C.PIPELINE_MIX)})").fetchall()
    assert sorted(str(d) for d, _ in rows[4]) == sorted(str(d) for (d,) in want)

    tokenizer = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    check_pieces(found[5].collect(), rows[4], tokenizer, 4096)


def test_run_is_the_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in C.STAGES:
        docs = stored(stage(spark, docs, sf), "test")
    assert sorted(map(str, C.run(spark, sf).collect())) == sorted(map(str, docs.collect()))


def test_empty_documents(spark, empty_docs):
    docs = empty_docs.select(*COLUMNS)
    for _, stage in C.STAGES:
        docs = stored(stage(spark, docs, "unused"), "test")
        assert docs.count() == 0
