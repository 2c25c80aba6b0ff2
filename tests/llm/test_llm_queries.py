"""The registered training-data queries: against SQL, a plain version, or held-out labels."""

import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

import brute
import compare
import corpus_pipeline
from netpulse.llm.catalog import ORACLES, QUERIES, public_vocabulary
from netpulse.llm import near_dedup, packing, suffix_dedup


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.fixture(scope="module")
def texts(sf_dir):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, duck, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name, parts, rest, least", [("op1_quality", 3, 1, 0.9), ("op6_toxicity", 4, 2, 0.9)])
def test_classifier_on_held_out_rows(spark, sf_dir, name, parts, rest, least):
    """On the table of 1,000 documents: the smallest one has 23 labelled rows held out."""
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    rows = QUERIES[name](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d for d, _ in texts)
    limit = {"op1_quality": 0.5, "op6_toxicity": 0.3}[name]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == rest)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= limit)
    column = {"op1_quality": "quality", "op6_toxicity": "toxic"}[name]
    marked = dict(duckdb.sql(f"SELECT doc_id, {column} FROM '{sf_dir}/labels.parquet'").fetchall())
    judged = [(marked[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in marked]
    assert sum(a == b for a, b in judged) >= least * len(judged)
    # the rarer label, so that always answering the other one does not do
    rare = min((0, 1), key=lambda k: sum(a == k for a, _ in judged))
    caught = sum(a == b == rare for a, b in judged)
    assert caught >= 0.9 * sum(a == rare for a, _ in judged) and caught >= 0.7 * sum(b == rare for _, b in judged)


@pytest.mark.parametrize("batches, limit", [(2, 2000), (5, 3)])
def test_suffix_dedup(spark, sf_dir, texts, monkeypatch, batches, limit):
    monkeypatch.setattr(suffix_dedup, "GROUP_LIMIT", limit)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.repeated_passages(docs, batches).collect()}
    assert found == brute.repeated_passages(texts)


# the small limits send rows down the trees, and those that nothing parts to the blocks
@pytest.mark.parametrize("limit, levels", [(512, 16), (4, 16), (4, 1)])
def test_near_dedup(spark, sf_dir, texts, monkeypatch, limit, levels):
    monkeypatch.setattr(near_dedup, "NODE_LIMIT", limit)
    monkeypatch.setattr(near_dedup, "LEVELS", levels)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op10_near_dedup"](spark, sf_dir).collect()}
    assert found == brute.near_duplicates(texts)


def test_personal_data(spark, sf_dir, texts):
    rows = QUERIES["op9_personal_data"](spark, sf_dir).collect()
    expected = {d: brute.base_spans(t) for d, t in texts}
    assert {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows} == expected


def check_packed(rows, expected_ids):
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(expected_ids)
    for doc_id, ids in expected_ids.items():
        place = 0
        for k, r in enumerate(sorted(pieces[doc_id], key=lambda r: r.piece)):
            own = b"".join(i.to_bytes(4, "little") for i in ids[place : place + r.length])
            assert (r.piece, r.start, r.ids_crc32) == (k, place, zlib.crc32(own))
            assert r.length == 2048 or k == 0
            place += r.length
        assert place == len(ids) and (len(ids) > 2048 or k == 0)
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    return len(bins), sum(len(i) for i in expected_ids.values())


def test_packing(spark, sf_dir, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_vocabulary()[0])
    expected = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for d, t in texts}
    made, tokens = check_packed(QUERIES["op8_packing"](spark, sf_dir).collect(), expected)
    assert made <= -(-tokens // 2048) * 1.02 + 1


def test_pipeline(spark, sf_dir, texts):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, columns = docs.count(), docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == columns
        after = docs.count()
        assert 0 < after <= before
        if name == "near_dedup":
            kept = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
            assert all(k for _, _, k in brute.near_duplicates(kept).values())
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_near_stage_takes_80_percent(spark, sf_dir):
    """Texts of 50 shingles that share 45 with the first one (82 percent), 44 (79) and 46 (85)."""
    base = [f"w{i}" for i in range(54)]
    texts = [" ".join(base + [])] + [" ".join(base[:k] + [f"x{k}{i}" for i in range(54 - k)]) for k in (49, 48, 50)]
    texts += [" ".join(f"{w}{g}" for w in t.split()) for g in "abcdefgh" for t in texts]
    rows = [(i, t, "en", "web", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, sf_dir).collect()}
    expected = {d for d, (_, _, k) in brute.near_duplicates([r[:2] for r in rows], 80).items() if k}
    at_85 = {d for d, (_, _, k) in brute.near_duplicates([r[:2] for r in rows], 85).items() if k}
    assert kept == expected and kept < at_85


def test_near_rule():
    """At 80 a cut of 40 of 64 would lose 3.5e-4 of the pairs; one tree less would lose more than allowed."""
    for percent, least in ((85, 38), (80, 33)):
        rule = near_dedup.rule_of(percent)
        assert rule.least_shared == least
        assert near_dedup.miss_rate(percent / 100, rule.trees) <= near_dedup.MISS < near_dedup.miss_rate(percent / 100, rule.trees - 1)


@pytest.mark.parametrize("similarity, trees", [(0.85, 1), (0.85, 2), (0.7, 2)])
def test_near_miss_rate(similarity, trees):
    """The computed miss rate against trees branched step by step, 25 levels deep."""
    rng = np.random.default_rng(int(similarity * 100) + trees)
    runs, lost = 20_000, 0
    for _ in range(runs):
        agrees = rng.random(64) < similarity
        met = False
        for root in range(trees):
            paths = int(agrees[root])
            for _ in range(25):
                # beyond 30 shared paths all of them hardly end any more
                if not 0 < paths < 30:
                    break
                paths = int(agrees[rng.integers(0, 64, paths * near_dedup.PATHS)].sum())
            met |= paths > 0
        lost += not met
    expected = near_dedup.miss_rate(similarity, trees)
    assert abs(lost / runs - expected) < 5 * (expected / runs) ** 0.5 + 1e-3


# a third of the words and more in common: blocks; a few: paths, which then make fewer rows
@pytest.mark.parametrize("common, levels", [(88, 16), (60, 16), (8, 16), (8, 1), (8, 0)])
def test_near_pairs_in_crowded_nodes(spark, monkeypatch, common, levels):
    """Pairs at just 85 percent (102 of 120 shingles) where every root node holds all rows, which share a passage."""
    monkeypatch.setattr(near_dedup, "NODE_LIMIT", 16)
    monkeypatch.setattr(near_dedup, "LEVELS", levels)
    rows = []
    for i in range(400):
        text = [f"c{k}" for k in range(common + 4)] + [f"u{i}x{k}" for k in range(111 - common)]
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(text[:106] + [f"v{i}x{k}" for k in range(9)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signed = near_dedup.signatures(docs)
    trees = near_dedup.rule_of(85).trees
    alike = "concat(X'" + "07" * 4 * trees + f"', substring(signature, {4 * trees + 1}, 1000))"
    members = signed.selectExpr("doc_id AS rep", "n_shingles AS n", f"{alike} AS signature")
    found = {tuple(sorted(r)) for r in near_dedup.verified_links(docs, near_dedup.stage(members, "alike")).collect()}
    assert found == {(2 * i, 2 * i + 1) for i in range(400)}


@pytest.mark.parametrize("common", [8, 60])
def test_copies_of_a_row_in_crowded_nodes(spark, common):
    """Where paths thin a crowded node out, a row of it is copied a few times however many rows there are."""
    copies = {}
    for size in (8_000, 32_000):
        # rows whose signatures agree on a share of the values, and on all roots
        rng = np.random.default_rng(common)
        values = rng.integers(0, 2**32, (size, 64), dtype=np.uint32)
        values[rng.random((size, 64)) < common / 200] = 7
        values[:, : near_dedup.rule_of(85).trees] = 7
        frame = pd.DataFrame({"rep": np.arange(size), "n": 100, "signature": [v.tobytes() for v in values]})
        members = spark.createDataFrame(frame, "rep long, n long, signature binary")
        leaves = near_dedup._leaves(members, near_dedup.rule_of(85)).where("tree = 0")
        assert leaves.groupBy("node").count().agg({"count": "max"}).first()[0] <= 2 * near_dedup.BLOCK * near_dedup.NODE_LIMIT * 1.2
        copies[size] = leaves.count() / size
    assert copies[32_000] <= max(near_dedup.PATHS**4, 1.5 * copies[8_000])


def test_packing_of_added_tokens(spark):
    """Strings of the file's added tokens get the ids that the file gives them."""
    from tokenizers import Tokenizer

    texts = [(1, "end <|endoftext|> begin"), (2, "<|endoftext|>" * 3), (3, "no <|endoftext| > here"), (4, "日本 <|endoftext|>"), (5, "plain words")]
    tokenizer = Tokenizer.from_file(public_vocabulary()[0])
    expected = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for d, t in texts}
    assert len(expected[1]) == 5
    pieces = packing.token_pieces(spark.createDataFrame(texts, "doc_id long, text string"), *public_vocabulary())
    check_packed(packing.pack(pieces).collect(), expected)


@pytest.mark.parametrize("bits", [64, 1 << 10, 1 << 26])
def test_filter_keeps_all_needed_ids(spark, monkeypatch, bits):
    """Whatever its size, the filter loses no id; a large one keeps few others."""
    monkeypatch.setattr(near_dedup, "FILTER_BITS", bits)
    rows = spark.range(-500, 4500).selectExpr("id AS doc_id", "'t' AS text").unionByName(spark.createDataFrame([(None, "t")], "doc_id long, text string"))
    kept = {r.doc_id for r in near_dedup._likely(rows, rows.select("doc_id").where("doc_id % 9 = 0")).collect()}
    needed = {i for i in range(-500, 4500) if i % 9 == 0}
    assert needed <= kept and (bits < 1 << 26 or len(kept) < len(needed) + 5)
