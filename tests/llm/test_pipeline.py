"""The pipeline's stages, each against the operator it stands for."""

import public_tokenizers
from test_copies import brute as plain_copies
from test_jaccard import brute as plain_groups
from test_mixing import plain_targets
from test_tokens import check_packing
from tokenizers import Tokenizer

import corpus_pipeline
from tonetape.llm.common import written
from tonetape.llm.toxicity import toxicity

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "mixing", "packing"]
    given = docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [given]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        tables.append(docs)
    for table in tables[:-1]:
        assert table.columns == given.columns
    rows = [[(r.doc_id, r.text, r.source) for r in t.collect()] for t in tables[:-1]]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    civil = {r.doc_id for r in toxicity(given, labels).collect() if not r.predicted}
    assert {i for i, *_ in rows[1]} == civil
    own = [(i, t) for i, t, _ in rows[1]]
    assert sorted(i for i, *_ in rows[2]) == sorted({k for _, k, *_ in plain_copies(own, "largest")})
    own = [(i, t) for i, t, _ in rows[2]]
    assert sorted(i for i, *_ in rows[3]) == sorted({c for _, _, c in plain_groups(own)})
    size = lambda t: len(t.split())
    total = {}
    for _, t, s in rows[3]:
        total[s] = total.get(s, 0) + size(t)
    taken = dict.fromkeys(total, 0)
    for _, t, s in rows[4]:
        taken[s] += size(t)
    for s, want in plain_targets(total).items():
        assert abs(taken[s] - want) <= max(60, 0.1 * want)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    check_packing(tables[-1].collect(), [(i, t) for i, t, _ in rows[4]], library, 2048)


def test_stages_take_odd_rows_and_names(spark):
    """Null and empty texts, ids and sources, a very long text, repeated rows, names with dots and clashing ones."""
    long = " ".join(f"word{i}" for i in range(40_000))
    odd = [(None, "no id here", "en", "src1"), (90_001, None, None, None), (90_002, "", "en", "src1"), (90_003, long, "fr", None)]
    odd += [(90_004, "twice the same row", "en", "src2")] * 2 + [(90_005, long, "fr", "src0"), (90_006, " \n ", "de", "src3")]
    given = spark.read.parquet(f"{SF}/documents.parquet").drop("n_chars")
    extra = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string")
    docs = given.unionByName(extra).selectExpr(
        "*", "1 AS `a.b`", "2 AS n_chars", "3 AS score", "4 AS `row`", "5 AS dedup_row", "6 AS mix_row", "'x' AS id", "7 AS c0", "8 AS `ti``ck`"
    )
    names = docs.columns
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), name)
        assert docs.columns == names, name
        tables.append(docs)
    ids = [[r.doc_id for r in t.where("doc_id IS NULL OR doc_id > 90000").select("doc_id").collect()] for t in tables]
    assert sorted(ids[1], key=str) == sorted(ids[0], key=str)
    # Of the empty texts, of the long ones, and of the repeated row, one stays.
    assert sorted(ids[2], key=str) == [90_002, 90_004, 90_005, 90_006, None]
    assert sorted(ids[3], key=str) == sorted(ids[2], key=str)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).where("doc_id = 90005").collect()
    assert sum(p["length"] for p in pieces) == sum(p["doc_tokens"] for p in pieces if p["start"] == 0)
    assert sum(p["start"] == 0 for p in pieces) == ids[4].count(90_005)


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "empty")
        assert docs.count() == 0
