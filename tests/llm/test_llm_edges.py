"""Nulls, empty and very long texts, repeated rows and ids, empty tables, clashing extra columns."""

import pytest

import corpus_pipeline
from netpulse.llm import exact_dedup, exact_topk, licences, mixing, near_dedup, packing, personal, quality, suffix_dedup, toxicity
from netpulse.llm.catalog import public_vocabulary
from netpulse.llm.common import read

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, key string, a long, node long, bucket int, level int, score double"
PASSAGE = "the quiet river carries seven old boats past the mill while nobody on either bank looks up from work or counts them today "
ROWS = [
    (1, PASSAGE, "en", "web", 1), (2, PASSAGE, None, None, 1), (2, PASSAGE, "en", "web", 1), (2, PASSAGE, "en", "web", 1), (3, None, "en", None, None),
    (4, "", None, "web", 0), (None, PASSAGE * 3, "en", "web", 5), (None, None, None, None, None), (5, " \t\n ", "en", "web", 3),
    (6, "word " * 40_000, "en", "web", 200_000), (7, "x" * 150_000, "de", "web", 150_000), (8, "mail a@b.org +49 170 1234567 10.0.0.1", "en", "books", 30),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 9, "k", 9, 9, 9, 9, 0.5) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return read(spark, sf_dir, "labels")


def topics(spark):
    return spark.createDataFrame([(1, 3), (1, 2), (2, None), (None, 4)], "doc_id long, topic int")


OPERATORS = {
    "quality": lambda spark, docs, labels: quality.score(docs, quality.fit(docs, labels)),
    "toxicity": lambda spark, docs, labels: toxicity.score(docs, toxicity.fit(docs, labels)),
    "mixing": lambda spark, docs, labels: mixing.calibrated(docs, topics(spark)),
    "licences": lambda spark, docs, labels: licences.license_scan(docs),
    "suffixes": lambda spark, docs, labels: suffix_dedup.repeated_passages(docs),
    "exact": lambda spark, docs, labels: exact_dedup.exact_duplicates(docs),
    "personal": lambda spark, docs, labels: personal.find_personal(docs),
    "near": lambda spark, docs, labels: near_dedup.near_duplicates(docs),
}


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"licences"}))
def test_one_row_per_row(spark, docs, labels, name):
    rows = OPERATORS[name](spark, docs, labels).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, docs, labels, name):
    assert OPERATORS[name](spark, docs.limit(0), labels).collect() == []


def test_licences_run(spark, docs, labels):
    assert OPERATORS["licences"](spark, docs, labels).count() >= 0


def test_exact_groups(spark, docs):
    rows = exact_dedup.exact_duplicates(docs).collect()
    copies = [r for r in rows if r.doc_id in (1, 2)]
    assert {(r.keep_id, r.group_size) for r in copies} == {(1, 4)} and sum(r.kept for r in copies) == 1


def test_near_groups(spark, docs):
    rows = near_dedup.near_duplicates(docs).collect()
    assert {r.component_id for r in rows if r.doc_id in (1, 2)} == {1}
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)


def test_repeats_of_repeated_ids(spark, docs):
    rows = suffix_dedup.repeated_passages(docs, with_kept=True).collect()
    size = len(PASSAGE)
    assert [r.n_removed for r in rows if r.doc_id == 1] == [0]
    assert [r.n_removed for r in rows if r.doc_id == 2] == [size] * 3
    long = next(r for r in rows if r.doc_id == 7)
    assert long.n_removed == 149_999 and bytes(long.kept) == b"x"


def test_packing_of_odd_rows(spark, docs):
    rows = packing.pack(packing.token_pieces(docs, *public_vocabulary())).collect()
    assert sum(r.piece == 0 for r in rows) == len(ROWS)
    assert sorted(r.length for r in rows if r.doc_id in (3, 4)) == [1, 1]
    assert packing.pack(packing.token_pieces(docs.limit(0), *public_vocabulary())).collect() == []


def test_vectors(spark):
    odd = [(0, [1.0, 2.0]), (1, None), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, [1.0, 2.0]), (50, [0.0, 1.0]), (None, [1.0, 1.0])]
    frame = spark.createDataFrame(odd, "vec_id long, embedding array<double>")
    found = [(r.query_id, r.rank, r.vec_id, r.score) for r in exact_topk.top_k(frame, 5, 50).collect() if r.vec_id is not None]
    assert (0, 1, 4, 327_680) in found and (50, 1, 0, 131_072) in found
    assert not {1, 2, 3} & {f[2] for f in found}
    assert exact_topk.top_k(frame.limit(0), 5, 50).collect() == []


def test_stages_keep_odd_columns(spark, docs, sf_dir):
    rows = docs
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stage(step(spark, rows, sf_dir), "edge")
        assert out.columns == rows.columns
        rows = out
    assert corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir).count() >= 0


def test_helper_names_are_free(spark, sf_dir):
    """Columns called as the stages call their own, one with a map, one with a dot."""
    fixed = "doc_id long, text string, lang string, source string"
    schema = fixed + ", row_key string, Row_Place int, dropped_id long, `a.b` string, m map<string,int>"
    values = [(1, "one text"), (2, "one  text"), (3, PASSAGE), (4, PASSAGE + "and more")]
    docs = spark.createDataFrame([(*v, "en", "web", f"k{v[0]}", 5, 1, "dot", {"x": 1}) for v in values], schema)
    exact = exact_dedup.without_exact_copies(docs)
    near = near_dedup.without_near_copies(docs)
    assert exact.columns == near.columns == mixing.sample_mixture(docs, topics(spark), 1.0).columns == docs.columns
    assert sorted(r.doc_id for r in exact.collect()) == [1, 3, 4]
    assert sorted((r.doc_id, r.row_key, r.dropped_id) for r in near.collect())[-1] == (3, "k3", 1)
    assert {r.doc_id for r in mixing.sample_mixture(docs, topics(spark), 1.0).collect()} <= {1, 2, 3, 4}


def test_repeated_rows_keep_the_same_one(spark):
    rows = [(1, "same text", f"place {i}", None if i % 2 else i) for i in range(40)]
    kept = set()
    for parts in (1, 4, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(parts)
        found = exact_dedup.without_exact_copies(docs).collect()
        assert len(found) == 1
        kept.add(tuple(found[0]))
    assert len(kept) == 1
