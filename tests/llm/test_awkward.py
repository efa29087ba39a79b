"""Every operator over tables with nulls, repeated rows, a very long text and extra columns of its own names, and over empty ones."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import byte_bpe, exact_topk, hard_negatives, packing, projection_forest, quality, queries, simhash, similar_sets, substring_dedup, suffix_dedup, token_files, url_filter

#: Names that operators use or return; all are strings here.
CLASHING = (
    "n_tokens start ids_crc32 shard block among piece length part nth sequence_id offset fp fingerprint component_id root node kept spans n_removed n_words batch bucket data "
    "carry_0 evidence site score keep bad labelled host path n ids ids_sha256 decoded_sha256"
).split()
WORDS = public_tokenizers.path(queries.WORDS)
LONG = " ".join(f"word{i % 977} {i}" for i in range(120_000))


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(1, LONG, "s", "en"), (1, LONG, "s", "en"), (2, None, None, None), (None, "a b c", "s", None), (None, None, None, None), (3, "", "", ""), (3, " \n\t", "s", "en"), (4, "x", "s", "en"), (4, "x", "s", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    return docs.withColumns({name: F.lit("clash") for name in CLASHING})


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


RUNS = {
    "op1": lambda spark, docs, tmp: substring_dedup.substring_dedup(docs),
    "op2": lambda spark, docs, tmp: quality.judge(docs, labels(spark)),
    "op3": lambda spark, docs, tmp: (token_files.write_token_files(docs, tmp, WORDS, 1), token_files.documents_of(token_files.read_token_files(spark, tmp)))[1],
    "op6": lambda spark, docs, tmp: suffix_dedup.suffix_dedup(docs, carry=["kept", "n_removed"]),
    "op7": lambda spark, docs, tmp: byte_bpe.round_trip_digest(docs, public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN),
    "op9": lambda spark, docs, tmp: simhash.near_duplicates(docs),
    "op10": lambda spark, docs, tmp: packing.pack_documents(docs, WORDS).where("piece = 0"),
}


@pytest.mark.parametrize("name", RUNS)
def test_every_row_has_an_answer(spark, awkward, tmp_path, name):
    found = RUNS[name](spark, awkward, str(tmp_path / "some"))
    ids = sorted((r[0] or -1) for r in found.select("doc_id").collect())
    assert ids == [-1, -1, 1, 1, 2, 3, 3, 4, 4]
    assert RUNS[name](spark, awkward.limit(0), str(tmp_path / "none")).count() == 0


def test_similar_sets_leave_out_null_ids_only(spark, awkward):
    found = {(r["doc_id"], r["component_id"]) for r in similar_sets.similar_documents(awkward).collect()}
    assert found == {(1, 1), (2, 2), (3, 2), (4, 4)}


@pytest.mark.parametrize("search", ["nearest", "top_by_inner_product", "hard_negatives"])
def test_vectors_with_clashing_columns(spark, search):
    run = {"nearest": projection_forest.nearest, "top_by_inner_product": exact_topk.top_by_inner_product, "hard_negatives": hard_negatives.hard_negatives}[search]
    rows = [(i, [float(i % 7), 1.0, float(i % 3)], i % 3) for i in range(120)] + [(None, [1.0] * 3, 1), (100, [1.0] * 3, None), (200, None, 1)]
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    clash = "v width query query_id block query_block rank score first ids nth leaf tree uid place least most low high n g z x".split()
    found = [sorted(map(str, run(df).collect())) for df in (plain, plain.withColumns({name: F.lit("clash") for name in clash}))]
    assert found[0] == found[1] and found[0]


def test_urls_with_clashing_columns_ties_and_long_pages(spark):
    rows = [(1, "http://a.com/x", "<a href='http://b.org'>" * 50_000), (1, "http://a.com/x", None), (None, None, None), (2, "http://b.org/" + "p" * 500_000, ""), (3, "http://both.net/es/", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({name: F.lit("clash") for name in "host path rule rules verdict trust distrust links fit by_rule salt up src dst weight".split()})
    tied = [*queries.RULES, ("both.net/", "allow"), ("both.net/es/", "allow"), ("both.net/es/", "block")]
    found = url_filter.judge_urls(pages, tied).collect()
    assert sorted((r["page_id"] or -1) for r in found) == [-1, 1, 1, 2, 3]
    assert {r["verdict"] for r in found if r["page_id"] == 1} == {"allow"} and next(r for r in found if r["page_id"] == 3)["rule"] == "both.net/es/"
